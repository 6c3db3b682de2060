"""Staging, history, benchmark and mart models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import labels
from tidemark.functions.keys import attribute_hash
from tidemark.functions.numeric import exact_mean, percent, round_half_away
from tidemark.operators import history as hist
from tidemark.operators import ranks
from tidemark.operators.newest import before_latest, latest_release, latest_slice, newest_by_group
from tidemark.operators.shape import max_for_item, newer_than_loaded, not_yet_done
from tidemark.sources.feeds import DIM_HOSPITAL_CONTRACT

TRACKED = ["facility_name", "hospital_type", "ownership", "overall_rating", "has_emergency_services",
           "is_birthing_friendly"]


def stg_hospitals(silver: DataFrame) -> DataFrame:
    return (silver.withColumn("ownership_group", labels.ownership_group(F.col("ownership")))
                  .withColumn("overall_rating", F.col("overall_rating").cast("int"))
                  .withColumn("release_date", F.col("release_date").cast("date"))
                  .withColumnRenamed("_ingested_at", "ingested_at"))


def stg_measure_scores(silver: DataFrame) -> DataFrame:
    return (silver.withColumn("comparison_category", labels.comparison_category(F.col("compared_to_national")))
                  .withColumn("release_date", F.col("release_date").cast("date"))
                  .withColumnRenamed("_ingested_at", "ingested_at"))


def stg_survey(silver: DataFrame) -> DataFrame:
    return (silver.withColumn("is_star_measure", labels.is_star_item(F.col("measure_id")))
                  .withColumn("release_date", F.col("release_date").cast("date"))
                  .drop("_ingested_at"))


def hospital_versions(stg: DataFrame, guard_nulls: bool = False) -> DataFrame:
    """Version history of the tracked attributes.

    ``guard_nulls`` gives NULL attributes a mark of their own in the hash; the
    default leaves them out, apart from the rating.
    """
    return (hist.versions(stg, "facility_id", "release_date", tracked_hash(guard_nulls), CARRIED)
                .withColumnRenamed("version_key", "hospital_version_key"))


CARRIED = ["facility_name", "state", "hospital_type", "ownership", "ownership_group", "overall_rating",
           "has_emergency_services", "is_birthing_friendly"]


def tracked_hash(guard_nulls: bool = False) -> Column:
    return attribute_hash(TRACKED, null_marks={"overall_rating": "NA"}, guard_nulls=guard_nulls)


@dataclass(frozen=True)
class History:
    """Version history in a form that takes new releases.

    ``closed`` holds versions that another one of their facility follows; they
    change only when a release before their end does.  ``latest`` holds each
    facility's last version and the releases it was seen in.
    """

    closed: DataFrame
    latest: DataFrame

    def versions(self, releases: DataFrame) -> DataFrame:
        """The history over the given ``release_date`` days."""
        calendar = hist.release_calendar(releases)
        starts = self.closed.unionByName(self.latest.withColumn("next_from", F.lit(None).cast("date")), allowMissingColumns=True)
        return (hist.versions_of(starts, calendar, "facility_id", "release_date", CARRIED)
                    .withColumnRenamed("version_key", "hospital_version_key"))


def _split(starts: DataFrame) -> History:
    return History(starts.where("next_from is not null").drop("seen"), starts.where("next_from is null").drop("next_from"))


def merge_releases(history: History | None, stg: DataFrame) -> History:
    """The history after releases past all known ones arrived (``stg`` holds only their rows).

    The result's ``closed`` holds what was closed now, to be kept beside what was closed before.
    """
    return _split(hist.merged_starts(history.latest if history else None, stg, "facility_id", "release_date", tracked_hash(), CARRIED))


def reopen_releases(history: History, stg: DataFrame, releases: Sequence[str]) -> History:
    """The history after releases between known ones arrived, changed or went.

    Only facilities that were or are in these releases are worked out anew, from
    all of their rows in ``stg``; all other versions are passed on.  ``releases`` are
    literals, so the facilities are found in their folders alone.
    """
    days = [F.lit(r).cast("date") for r in sorted(releases)]
    here = stg.where(F.col("release_date").isin(days)).select("facility_id")
    were = history.latest.where(F.arrays_overlap("seen", F.array(*days))).select("facility_id")
    touched = here.unionByName(were).distinct()
    again = merge_releases(None, stg.join(touched, "facility_id", "left_semi"))
    return History(history.closed.join(touched, "facility_id", "left_anti").unionByName(again.closed),
                   history.latest.join(touched, "facility_id", "left_anti").unionByName(again.latest))


def survey_pivot(stg: DataFrame) -> DataFrame:
    return stg.groupBy("facility_id", "release_date").agg(
        *[max_for_item("measure_id", item, "star_rating").alias(name) for name, item in fv.STAR_ITEMS.items()],
        *[max_for_item("measure_id", item, "answer_percent").alias(name) for name, item in fv.PERCENT_ITEMS.items()],
        F.max("completed_surveys").alias("completed_surveys"),
        F.max("response_rate_pct").alias("response_rate_pct"))


def score_counts(stg: DataFrame) -> DataFrame:
    """Rows per measure, release and score, and how many of them are rated: all that medians and percentiles need."""
    rated = labels.is_rated(F.col("score"), F.col("comparison_category"))
    placeable = F.col("measure_id").isNotNull() & F.col("release_date").isNotNull()
    return ranks.value_counts(stg.where(placeable), ["measure_id", "release_date"], "score", {"n": F.lit(True), "n_rated": rated})


def benchmark_scores(stg: DataFrame, catalog: DataFrame, stored_counts: DataFrame | None = None) -> DataFrame:
    """Each score with the median of its peers, the gap to it and a percentile (100 is best).

    Peers are the rated rows of the same measure and release; ``stored_counts`` are the
    ``score_counts`` of these releases, where they are kept.
    """
    groups = ["measure_id", "release_date"]
    known = catalog.select("measure_id", "lower_is_better", "domain", "measure_short_name")
    scores = (stg.join(known, "measure_id", "left")
                 .withColumn("lower_is_better", F.coalesce("lower_is_better", F.lit(True))))
    rated = labels.is_rated(F.col("score"), F.col("comparison_category"))

    # A row without measure or release has no peers.  Saying so here gives every
    # branch below the same filter, and with it the same shuffle to reuse.
    placeable = F.col("measure_id").isNotNull() & F.col("release_date").isNotNull()
    counts = (ranks.ordered_counts(stg.where(rated & placeable), groups, "score") if stored_counts is None
              else ranks.ordered_counts(stored_counts, groups, "score", rows="n_rated"))
    medians = (ranks.quantiles_from_counts(counts, groups, "score", {"national_median": 0.5})
                    .select(*groups, "national_median"))
    peers = (counts.join(medians, groups)
                   .select(*groups, "score", "national_median", ranks.percent_rank_from_counts().alias("_rank")))
    placed = ranks.attach_by_value(scores, peers, groups, "score", rated, ["facility_id", *groups])
    best_is_100 = F.when(F.col("lower_is_better"), F.lit(1.0) - F.col("_rank")).otherwise(F.col("_rank"))
    return (placed.withColumn("diff_from_national_median",
                              round_half_away(F.col("score") - F.col("national_median"), 3))
                  .withColumn("performance_percentile", round_half_away(F.lit(100.0) * best_is_100, 1))
                  .drop("_rank"))


FACT_COLUMNS = ["facility_id", "measure_id", "release_date", "domain", "source_dataset", "comparison_category",
                "compared_to_national", "denominator", "score", "lower_estimate", "higher_estimate", "national_median",
                "diff_from_national_median", "performance_percentile", "period_start", "period_end"]


def fct_measure_scores(stg: DataFrame, catalog: DataFrame, loaded: DataFrame | None = None,
                       by: str = "feed") -> DataFrame:
    """The fact rows that are not in ``loaded`` yet; all of them without it.

    ``by="feed"`` looks for (source_dataset, release_date) pairs that are not
    loaded, so a feed that arrives late with an older date is still picked up.
    ``by="newest"`` takes only releases past the newest loaded one.  Either way
    peers are compared over whole releases.
    """
    if loaded is None:
        return benchmark_scores(stg, catalog).select(*FACT_COLUMNS)
    if by == "newest":
        return benchmark_scores(newer_than_loaded(stg, loaded), catalog).select(*FACT_COLUMNS)
    pair = ["source_dataset", "release_date"]
    fresh: dict[str, list] = {}
    for feed, release in not_yet_done(stg, loaded, pair).collect():  # one row per feed and release
        fresh.setdefault(feed, []).append(release)
    if not fresh:
        return benchmark_scores(stg.where(F.lit(False)), catalog).select(*FACT_COLUMNS)
    touched = sorted({release for releases in fresh.values() for release in releases})
    wanted = reduce(lambda a, b: a | b, [(F.col("source_dataset") == feed) & F.col("release_date").isin(releases)
                                         for feed, releases in fresh.items()])
    peers = stg.where(F.col("release_date").isin(touched))  # literals, so other releases' folders are not opened
    return benchmark_scores(peers, catalog).where(wanted).select(*FACT_COLUMNS)


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp())


def dim_hospital(stg: DataFrame, regions: DataFrame, newest: str | None = None) -> DataFrame:
    named = latest_slice(stg, newest=newest).join(regions.select("state", "state_name", "census_region"), "state", "left")
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_HOSPITAL_CONTRACT.fields])


def dim_hospital_history(versions: DataFrame, regions: DataFrame) -> DataFrame:
    columns = versions.columns
    return versions.join(regions.select("state", "census_region"), "state", "left").select(*columns, "census_region")


def dim_measure(stg: DataFrame, catalog: DataFrame) -> DataFrame:
    observed = (newest_by_group(stg, "measure_id", ["measure_name", "source_dataset"], "release_date")
                .withColumnRenamed("measure_name", "source_measure_name"))
    return observed.join(catalog, "measure_id", "left").select(
        "measure_id",
        F.coalesce("measure_short_name", "source_measure_name").alias("measure_short_name"),
        "source_measure_name",
        F.coalesce("domain", F.lit("Uncatalogued")).alias("domain"),
        F.coalesce("lower_is_better", F.lit(True)).alias("lower_is_better"),
        "unit", "source_dataset")


def fct_patient_experience(pivoted: DataFrame) -> DataFrame:
    return pivoted


def _outcomes(facts: DataFrame) -> DataFrame:
    category, points = F.col("comparison_category"), F.col("performance_percentile")
    return facts.groupBy("facility_id").agg(
        F.count_if(category.isin(fv.RATED_CATEGORIES)).alias("measures_rated"),
        F.count_if(category == "better").alias("measures_better"),
        F.count_if(category == "worse").alias("measures_worse"),
        exact_mean(points, 1).alias("_mean_points"),
        *[exact_mean(F.when(F.col("domain") == domain, points), 1).alias(f"_{name}")
          for name, domain in fv.DOMAIN_PERCENTILES.items()])


def hospital_scorecard(dim: DataFrame, facts: DataFrame, experience: DataFrame, stg: DataFrame,
                       min_measures: int = fv.MIN_RATED_MEASURES, latest_facts: DataFrame | None = None,
                       latest_survey: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """One row per hospital of the dimension.

    ``latest_facts`` replaces the single newest release of the facts, for
    example by each feed's own newest one; ``latest_survey`` that of the survey, and
    ``previous`` (see ``previous_ratings``) the search through all older rows of ``stg``.  Every joined table is reduced to
    one row per facility first, so the joins share one partitioning by it.
    """
    current = latest_facts if latest_facts is not None else latest_slice(facts)
    before = previous if previous is not None else (
        newest_by_group(before_latest(stg), "facility_id", ["overall_rating"], "release_date")
        .withColumnRenamed("overall_rating", "previous_overall_rating"))
    surveyed = latest_survey if latest_survey is not None else latest_slice(experience)
    survey = surveyed.select("facility_id", F.col("summary_star").alias("patient_experience_star"),
                                             "pct_definitely_recommend", "completed_surveys")

    def counted(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    joined = reduce(lambda a, b: a.join(b, "facility_id", "left"), [_outcomes(current), before, survey], dim)
    card = joined.select(
        "facility_id", "facility_name", "city", "state", "state_name", "census_region", "hospital_type", "ownership",
        "ownership_group", "has_emergency_services", "overall_rating", "previous_overall_rating",
        (F.col("overall_rating") - F.col("previous_overall_rating")).alias("rating_change"),
        "patient_experience_star", "pct_definitely_recommend", "completed_surveys",
        *[counted(n).alias(n) for n in ("measures_rated", "measures_better", "measures_worse")],
        (counted("measures_better") - counted("measures_worse")).alias("net_outcome_signal"),
        *[round_half_away(F.col(f"_{n}"), 1).alias(n) for n in fv.DOMAIN_PERCENTILES],
        labels.only_with_support(round_half_away(F.col("_mean_points"), 1), F.col("measures_rated"),
                                 min_measures).alias("outcome_composite"))
    tiered = card.withColumn("outcome_tier", labels.outcome_tier(F.col("outcome_composite")))
    # The composite has one decimal between 0 and 100: at most 1001 values per state.
    return ranks.descending_rank(tiered, ["state"], "outcome_composite", "state_rank", ["facility_id"], few_values=True)


def previous_ratings(history: DataFrame, newest: str) -> DataFrame:
    """Each facility's newest known rating before a release, from its versions: a version's rows share its rating."""
    older = history.where(F.col("valid_from") < F.lit(newest).cast("date"))
    return (newest_by_group(older, "facility_id", ["overall_rating"], "valid_from")
            .withColumnRenamed("overall_rating", "previous_overall_rating"))


def state_summary(scorecard: DataFrame) -> DataFrame:
    rating, composite = F.col("overall_rating"), F.col("outcome_composite")
    return scorecard.groupBy("state", "state_name", "census_region").agg(
        F.count(F.lit(1)).alias("hospitals"),
        F.count(rating).alias("rated_hospitals"),
        round_half_away(exact_mean(rating, 0), 2).alias("avg_overall_rating"),
        round_half_away(percent(F.count_if(rating >= 4), F.count(rating)), 1).alias("pct_4_or_5_star"),
        round_half_away(exact_mean(F.col("patient_experience_star"), 0), 2).alias("avg_patient_experience_star"),
        round_half_away(exact_mean(composite, 1), 1).alias("avg_outcome_composite"),
        F.sum("measures_better").alias("measures_better"),
        F.sum("measures_worse").alias("measures_worse"),
        round_half_away(percent(F.sum("measures_worse"), F.sum("measures_rated")), 2).alias("pct_measures_worse"))


BENCHMARK_QUANTILES = {"p10": 0.10, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.90}


def measure_benchmarks(facts: DataFrame, measures: DataFrame, stored_counts: DataFrame | None = None) -> DataFrame:
    """Distribution of every measure per release over all scored rows."""
    return named_benchmarks(benchmark_numbers(facts, stored_counts), measures)


def benchmark_numbers(facts: DataFrame, stored_counts: DataFrame | None = None) -> DataFrame:
    """The numbers of ``measure_benchmarks``; quantiles come from ``score_counts`` of the same releases where these are kept."""
    groups = ["measure_id", "release_date"]
    category = F.col("comparison_category")
    rated = F.count_if(category.isin(fv.RATED_CATEGORIES))
    shares = facts.groupBy(*groups).agg(
        F.count("score").alias("hospitals_reported"),
        round_half_away(percent(F.count_if(category == "better"), rated), 2).alias("pct_better"),
        round_half_away(percent(F.count_if(category == "worse"), rated), 2).alias("pct_worse"))
    spread = (ranks.group_quantiles(facts, groups, "score", BENCHMARK_QUANTILES) if stored_counts is None
              else ranks.group_quantiles(stored_counts, groups, "score", BENCHMARK_QUANTILES, rows="n"))
    return shares.join(spread, groups, "left").select(
        *groups, "hospitals_reported", *[round_half_away(F.col(q), 3).alias(q) for q in BENCHMARK_QUANTILES], "pct_better", "pct_worse")


def named_benchmarks(numbers: DataFrame, measures: DataFrame) -> DataFrame:
    """One row per measure and release, with the names the measures have now."""
    named = measures.select("measure_id", "measure_short_name", "domain", "unit")
    return numbers.join(named, "measure_id").select(
        "measure_id", "measure_short_name", "domain", "unit", "release_date", "hospitals_reported", *BENCHMARK_QUANTILES, "pct_better", "pct_worse")


def quantiles_over(counts: DataFrame, releases: Sequence[str] | None = None) -> DataFrame:
    """Quantiles of every measure over a set of releases together, from their stored counts alone."""
    some = counts if releases is None else counts.where(F.col("release_date").isin([F.lit(r).cast("date") for r in releases]))
    spread = ranks.group_quantiles(some, ["measure_id"], "score", BENCHMARK_QUANTILES, rows="n")
    return spread.select("measure_id", F.col("n_total").alias("scores"), *[round_half_away(F.col(q), 3).alias(q) for q in BENCHMARK_QUANTILES])


def rating_changes(history: DataFrame) -> DataFrame:
    return hist.value_changes(history, "facility_id", "overall_rating",
                              ["facility_name", "state", "census_region", "hospital_type", "ownership_group"])


def newest_release_of(df: DataFrame) -> Column:
    return latest_release(df)
