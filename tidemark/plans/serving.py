"""Questions asked of the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import labels
from tidemark.functions.numeric import exact_mean, percent
from tidemark.operators.newest import latest_slice
from tidemark.operators.ranks import descending_rank, group_quantiles
from tidemark.operators.shape import equal_width_histogram

MIN_SUPPORT = 5
FULL_PROFILE_MEASURES = 15


# --- overview -------------------------------------------------------------------------
def national_kpis(scorecard: DataFrame) -> DataFrame:
    rating, change = F.col("overall_rating"), F.col("rating_change")
    return scorecard.agg(
        F.count(F.lit(1)).alias("hospitals"), F.count(rating).alias("rated"),
        exact_mean(rating, 0).alias("avg_rating"),
        percent(F.count_if(rating >= 4), F.count(rating)).alias("pct_top"),
        F.count_if(change > 0).alias("upgrades"), F.count_if(change < 0).alias("downgrades"),
        percent(F.sum("measures_worse"), F.sum("measures_rated")).alias("pct_worse"))


def rating_distribution(scorecard: DataFrame) -> DataFrame:
    """Hospitals per rating, unrated first."""
    return (scorecard.groupBy("overall_rating").agg(F.count(F.lit(1)).alias("n"))
                     .select(labels.rating_label(F.col("overall_rating")).alias("label"), "n",
                             F.coalesce("overall_rating", F.lit(0)).alias("ord"))
                     .orderBy("ord"))


def state_map(summary: DataFrame, at_least: int = MIN_SUPPORT) -> DataFrame:
    return summary.where(F.col("rated_hospitals") >= at_least).orderBy("state")


def ownership_balance(scorecard: DataFrame) -> DataFrame:
    """Shares of better and worse measures per ownership group, by net share."""
    rated = F.sum("measures_rated")
    return (scorecard.groupBy("ownership_group")
                     .agg(F.count(F.lit(1)).alias("hospitals"),
                          percent(F.sum("measures_better"), rated).alias("pct_better"),
                          percent(F.sum("measures_worse"), rated).alias("pct_worse"),
                          exact_mean(F.col("overall_rating"), 0).alias("avg_rating"), rated.alias("_rated"))
                     .where(F.col("_rated") > 0).drop("_rated")
                     .orderBy(F.col("pct_better") - F.col("pct_worse"), "ownership_group"))


# --- explorer -------------------------------------------------------------------------
def facet_values(scorecard: DataFrame, column: str) -> DataFrame:
    return scorecard.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def explore(scorecard: DataFrame, state: str | None = None, types: Sequence[str] = (),
            owners: Sequence[str] = (), min_rating: int | None = None) -> DataFrame:
    """Hospitals that meet the chosen facets; a minimum rating leaves the unrated out."""
    found = scorecard
    if state is not None:
        found = found.where(F.col("state") == state)
    if types:
        found = found.where(F.col("hospital_type").isin(list(types)))
    if owners:
        found = found.where(F.col("ownership_group").isin(list(owners)))
    if min_rating is not None:
        found = found.where(F.col("overall_rating") >= min_rating)
    return found


def best_first() -> list[Column]:
    return [F.desc_nulls_last("outcome_composite"), F.desc_nulls_last("overall_rating"), F.asc("facility_id")]


def ranked(found: DataFrame) -> DataFrame:
    return found.orderBy(*best_first())


def placed(found: DataFrame) -> DataFrame:
    """Place of every hospital in the ranking, ties sharing one.

    Composites have one decimal and ratings are 1 to 5, so there are few distinct
    pairs to count, however many hospitals there are.
    """
    pair = F.coalesce(F.round(F.col("outcome_composite") * 10), F.lit(-1)) * 10 + F.coalesce("overall_rating", F.lit(0))
    counted = descending_rank(found.withColumn("_all", F.lit(1)).withColumn("_pair", pair), ["_all"], "_pair", "place",
                              ["facility_id"], few_values=True)
    return counted.select("facility_id", "place")


def explorer_table(found: DataFrame) -> DataFrame:
    return ranked(found).select(
        "facility_id", "facility_name", "state", "hospital_type", "ownership_group",
        labels.star_glyphs(F.col("overall_rating")).alias("rating"),
        labels.change_text(F.col("rating_change")).alias("rating_change"),
        labels.star_glyphs(F.col("patient_experience_star")).alias("px_star"),
        "outcome_composite", "measures_better", "measures_worse")


def default_hospital(found: DataFrame) -> DataFrame:
    """Best-ranked hospital with a full profile, else the best-ranked one."""
    full = (F.col("measures_rated") >= FULL_PROFILE_MEASURES) & F.col("patient_experience_star").isNotNull()
    return found.orderBy(full.desc(), *best_first()).limit(1)


def hospital_measures(facts: DataFrame, measures: DataFrame, facility_id: str, newest: str | None = None) -> DataFrame:
    """One hospital's newest results; where the newest release is known, say from the version's entry, only its folder is opened."""
    named = measures.select("measure_id", "measure_short_name", "unit")
    mine = (latest_slice(facts, newest=newest)
            .where((F.col("facility_id") == facility_id) & F.col("performance_percentile").isNotNull()))
    return (mine.join(named, "measure_id")
                .select("measure_id", "measure_short_name", "domain", "comparison_category", "score", "lower_estimate",
                        "higher_estimate", "national_median", "performance_percentile", "unit")
                .orderBy(F.desc("domain"), "performance_percentile", "measure_id"))


SHOWN_STARS = [name for name in fv.STAR_ITEMS if name != "summary_star"]


def hospital_survey(experience: DataFrame, facility_id: str, newest: str | None = None) -> DataFrame:
    """The newest survey of one hospital; ``has_results`` is false when all nine stars are absent."""
    return (latest_slice(experience, newest=newest).where(F.col("facility_id") == facility_id)
            .withColumn("has_results", F.coalesce(*SHOWN_STARS).isNotNull()))


def hospital_history(history: DataFrame, facility_id: str) -> DataFrame:
    return (history.where(F.col("facility_id") == facility_id)
                   .select("valid_from", "valid_to", "overall_rating", "ownership", "hospital_type", "is_current")
                   .orderBy("valid_from"))


# --- benchmarks -----------------------------------------------------------------------
def latest_benchmarks(benchmarks: DataFrame, newest: str | None = None) -> DataFrame:
    return latest_slice(benchmarks, newest=newest).orderBy("domain", "measure_short_name", "measure_id")


def _with_state(facts: DataFrame, dim: DataFrame) -> DataFrame:
    return facts.join(dim.select("facility_id", "facility_name", "state"), "facility_id")


def reporting_states(facts: DataFrame, dim: DataFrame, measure_id: str | None = None) -> DataFrame:
    """States with a current hospital that reports a measure (one measure, or each)."""
    facts = facts if measure_id is None else facts.where(F.col("measure_id") == measure_id)
    pairs = facts.select("facility_id", "measure_id").distinct()
    return _with_state(pairs, dim).select("measure_id", "state").distinct().orderBy("measure_id", "state")


def current_scores(facts: DataFrame, dim: DataFrame, measure_id: str | None = None, newest: str | None = None) -> DataFrame:
    """Newest scores of hospitals that are still in the dimension."""
    facts = facts if measure_id is None else facts.where(F.col("measure_id") == measure_id)
    scored = latest_slice(facts, newest=newest).where(F.col("score").isNotNull())
    return _with_state(scored.select("facility_id", "measure_id", "score", "comparison_category"), dim)


def score_histogram(scores: DataFrame, bins: int = 40) -> DataFrame:
    return equal_width_histogram(scores, ["measure_id"], "score", bins).orderBy("measure_id", "bin")


def state_medians(scores: DataFrame, at_least: int = MIN_SUPPORT) -> DataFrame:
    medians = group_quantiles(scores, ["measure_id", "state"], "score", {"median_score": 0.5})
    return (medians.where(F.col("n_total") >= at_least)
                   .select("measure_id", "state", "median_score", F.col("n_total").alias("hospitals"))
                   .orderBy("measure_id", F.desc("median_score"), "state"))


# --- pipeline health ------------------------------------------------------------------
def run_history(runs: DataFrame, newest: int = 15) -> DataFrame:
    seconds = (F.unix_micros(F.col("finished_at")) - F.unix_micros(F.col("started_at"))) / F.lit(1e6)
    return (runs.orderBy(F.desc("started_at"), "run_id").limit(newest)
                .select("run_id", "source", "trigger", "status", "started_at", seconds.alias("duration_s"), "error"))


def last_success(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "success").orderBy(F.desc("finished_at"), "run_id").limit(1)


def task_durations(tasks: DataFrame, run_id: str | None = None) -> DataFrame:
    """Seconds per task and their total per run."""
    tasks = tasks if run_id is None else tasks.where(F.col("run_id") == run_id)
    total = F.sum(F.col("duration_s").cast("decimal(28,3)")).over(Window.partitionBy("run_id")).cast("double")
    return tasks.select("run_id", "task", "status", "duration_s", total.alias("run_s"))


def check_outcome() -> Column:
    return F.when(F.col("passed"), "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")


def check_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("passed").alias("passed"),
                       F.count_if(check_outcome() == "warn").alias("warnings"),
                       F.count_if(check_outcome() == "fail").alias("blocking"),
                       F.count(F.lit(1)).alias("checks"))


def check_list(results: DataFrame) -> DataFrame:
    """Results by outcome: failures, warnings, then passes."""
    severity = F.when(F.col("result") == "fail", 0).when(F.col("result") == "warn", 1).otherwise(2)
    return (results.withColumn("result", check_outcome())
                   .orderBy(severity, "dataset", "check_name")
                   .select("result", "dataset", "check_name", "severity", "observed", "threshold", "message"))


def bronze_volume(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("release_date").agg(F.sum("rows").alias("rows")).orderBy("release_date")


def manifest_list(manifest: DataFrame) -> DataFrame:
    return manifest.select("dataset", "release_date", "rows", labels.hash_prefix(F.col("content_sum")).alias("content"),
                           "ingested_at").orderBy("dataset", "release_date")


def layer_totals(manifest: DataFrame, silver_tables: DataFrame, published: DataFrame) -> DataFrame:
    """Rows per layer: landed, typed (with duplicates and rejects), published."""
    bronze = manifest.agg(F.lit("bronze").alias("layer"), F.sum("rows").alias("rows"),
                          F.lit(0).cast("bigint").alias("duplicates_removed"), F.lit(0).cast("bigint").alias("quarantined"))
    silver = silver_tables.agg(F.lit("silver").alias("layer"), F.sum("rows_out").alias("rows"),
                               F.sum("duplicates_removed").alias("duplicates_removed"), F.sum("quarantined").alias("quarantined"))
    gold = (published.select(F.explode("tables").alias("t", "n"))
                     .agg(F.lit("gold").alias("layer"), F.sum("n").alias("rows"),
                          F.lit(0).cast("bigint").alias("duplicates_removed"), F.lit(0).cast("bigint").alias("quarantined")))
    return bronze.unionByName(silver).unionByName(gold)


def newest_release(dim: DataFrame) -> DataFrame:
    return dim.agg(F.max("release_date").alias("release_date"))
