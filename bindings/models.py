"""Queries for the models and the questions asked of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import oracle
from bindings.registry import query
from tidemark import fixed_values as fv
from tidemark.functions import labels
from tidemark.operators import tests
from tidemark.plans import gold, serving, silver
from tidemark.sources.feeds import DIM_HOSPITAL_CONTRACT


def no_ingest(df):
    return df.drop("_ingested_at", "ingested_at")


ONE = "000003"   # the facility of the drill-down queries

# --- silver ---------------------------------------------------------------------------
@query("silver_hospitals", "I01 B10 B11", "select * exclude (_ingested_at) from silver_hospitals")
def _(c):
    return no_ingest(c.hospitals)


@query("silver_measures", "I02 A17 H02", "select * exclude (_ingested_at) from silver_measures")
def _(c):
    return no_ingest(c.measure_scores)


@query("silver_survey", "I03", "select * exclude (_ingested_at) from silver_survey")
def _(c):
    return no_ingest(c.hcahps)


_STATS_SQL = " union all ".join(
    f"select '{feed}' as feed, count(*) as rows_in, count(*) filter (where reason <> '') as quarantined, "
    f"count(*) filter (where reason = '' and {raw}) as unparseable_numerics, "
    f"count(*) filter (where reason = '') - (select count(*) from {rows}) as duplicates_removed, "
    f"(select count(*) from {rows}) as rows_out from clean_{feed}"
    for feed, rows, raw in (
        ("hospital_info", "silver_hospitals", "false"),
        ("complications_deaths", "silver_complications", f"score is not null and {oracle.num('score')} is null"),
        ("unplanned_visits", "silver_visits", f"score is not null and {oracle.num('score')} is null"),
        ("hcahps", "silver_survey", "false")))


def _feed_stats(c, feed):
    parts = silver.silver_parts(c.bronze(feed), feed)
    counts = parts.rows.agg(F.lit(feed).alias("feed"), F.count(F.lit(1)).alias("rows_out"))
    stats = parts.stats.withColumn("feed", F.lit(feed))
    return stats.join(counts, "feed").withColumn(
        "duplicates_removed", F.col("rows_in") - F.col("quarantined") - F.col("rows_out"))


@query("silver_stats", "I04 C04", _STATS_SQL)
def _(c):
    parts = [_feed_stats(c, f) for f in ("hospital_info", "complications_deaths", "unplanned_visits", "hcahps")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("quarantine_reasons", "A11 C01 C02 C03", " union all ".join(
    f"select '{feed}' as feed, release_date, reason as _reject_reason, count(*) as n from clean_{feed} "
    f"where reason <> '' group by 1, 2, 3" for feed in ("hospital_info", "complications_deaths", "unplanned_visits", "hcahps")))
def _(c):
    parts = [silver.silver_parts(c.bronze(f), f).bad.groupBy(F.lit(f).alias("feed"), "release_date", "_reject_reason")
             .agg(F.count(F.lit(1)).alias("n")) for f in ("hospital_info", "complications_deaths", "unplanned_visits", "hcahps")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- staging --------------------------------------------------------------------------
@query("stg_hospitals", "I05 B12", "select * from stg_hospitals")
def _(c):
    return no_ingest(gold.stg_hospitals(c.hospitals))


@query("stg_measure_scores", "I06 B13", "select * from stg_measures")
def _(c):
    return no_ingest(gold.stg_measure_scores(c.measure_scores))


@query("stg_survey", "I07 B14", "select * from stg_survey")
def _(c):
    return gold.stg_survey(c.hcahps)


# --- history, benchmark, marts --------------------------------------------------------
@query("hospital_versions", "I08 B16 B17 B25 F02 F03 F04 D04 D05 E11 E12", "select * from versions")
def _(c):
    return gold.hospital_versions(c.stg_hospitals)


@query("survey_pivot", "I09 I15 E02", "select * from survey_wide")
def _(c):
    return gold.fct_patient_experience(gold.survey_pivot(c.stg_survey))


@query("scores_benchmarked", "I10 D01 D03 C05 F05 F06 B18 B20 B23", "select * from benchmarked")
def _(c):
    return no_ingest(gold.benchmark_scores(c.stg_measures, c.catalog))


@query("dim_hospital", "I11 A16 B15 D02", "select * from dim")
def _(c):
    return gold.dim_hospital(c.stg_hospitals, c.regions)


@query("dim_hospital_history", "I12 D02", "select * from history")
def _(c):
    return gold.dim_hospital_history(gold.hospital_versions(c.stg_hospitals), c.regions)


@query("dim_measure", "I13 E03 D08 B23", "select * from measures")
def _(c):
    return gold.dim_measure(c.stg_measures, c.catalog)


@query("fct_measure_scores", "I14", "select * from facts")
def _(c):
    return c.facts


@query("fct_increment_newest", "I14 C09", "select * from facts where release_date > date '1998-01-01'")
def _(c):
    loaded = c.facts.where(F.col("release_date") <= F.lit("1998-01-01").cast("date"))
    return gold.fct_measure_scores(c.stg_measures, c.catalog, loaded, by="newest")


@query("fct_increment_feed", "I14 A09",
       "select * from facts where release_date > date '1998-01-01' or (source_dataset = 'unplanned_visits' and release_date < date '1996-01-01')")
def _(c):
    late = (F.col("source_dataset") == "unplanned_visits") & (F.col("release_date") < F.lit("1996-01-01").cast("date"))
    loaded = c.facts.where((F.col("release_date") <= F.lit("1998-01-01").cast("date")) & ~late)
    return gold.fct_measure_scores(c.stg_measures, c.catalog, loaded, by="feed")


@query("hospital_scorecard", "I16 D06 E01 E05 B21 B22 F07", "select * from scorecard")
def _(c):
    return gold.hospital_scorecard(c.dim, c.facts, c.experience, c.stg_hospitals)


@query("state_summary", "I17 E08 B19", "select * from states")
def _(c):
    return gold.state_summary(c.scorecard)


@query("measure_benchmarks", "I18 D07 E06 E07 E15", "select * from benchmarks")
def _(c):
    return gold.measure_benchmarks(c.facts, c.measures)


@query("rating_changes", "I19 F08 C06", "select * from changes")
def _(c):
    return gold.rating_changes(c.history)


# --- model tests ----------------------------------------------------------------------
@query("test_unique", "K01", "select overall_rating, count(*) as n from dim where overall_rating is not null group by 1 having count(*) > 1")
def _(c):
    return tests.repeated_values(c.dim, "overall_rating")


@query("test_not_null", "K02", "select * from dim where zip_code is null")
def _(c):
    return tests.null_rows(c.dim, "zip_code")


@query("test_accepted_values", "K03", "select * from stg_hospitals where ownership_group not in ('Non-profit', 'For-profit', 'Government')")
def _(c):
    return no_ingest(tests.unexpected_values(c.stg_hospitals, "ownership_group", ["Non-profit", "For-profit", "Government"]))


@query("test_relationships", "K04 D11",
       """select g.child, count(*) as offending, case when count(*) > 1000 then 'error' when count(*) > 0 then 'warn' else 'pass' end as grade
       from (select 'fact_measure' as child, measure_id as k from facts where measure_id not in (select measure_id from catalog)
             union all select 'fact_facility', facility_id from facts where facility_id not in (select facility_id from history)) as g
       group by 1""")
def _(c):
    by_measure = tests.orphan_counts(c.facts, "measure_id", c.catalog, "measure_id").select(F.lit("fact_measure").alias("child"), "n")
    by_facility = tests.orphan_counts(c.facts, "facility_id", c.history, "facility_id").select(F.lit("fact_facility").alias("child"), "n")
    found = by_measure.unionByName(by_facility).groupBy("child").agg(F.sum("n").alias("offending"))
    return found.withColumn("grade", tests.graded(F.col("offending"), 0, fv.ORPHAN_ERROR_ROWS))


@query("test_accepted_range", "K05", "select facility_id, measure_id, release_date, performance_percentile from facts where performance_percentile < 5 or performance_percentile > 95")
def _(c):
    return tests.out_of_range(c.facts, "performance_percentile", 5, 95).select(
        "facility_id", "measure_id", "release_date", "performance_percentile")


@query("test_unique_combination", "K06 E10", "select measure_id, release_date, count(*) as n from facts group by 1, 2 having count(*) > 1")
def _(c):
    return tests.duplicate_keys(c.facts, ["measure_id", "release_date"])


@query("test_history_tiling", "K07 F09", """select v.facility_id, v.valid_from, v.valid_to, (select min(n.valid_from) from history as n where n.facility_id = v.facility_id and n.valid_from > v.valid_from) as next_from
  from history as v where v.valid_to <= v.valid_from or exists (select 1 from history as n where n.facility_id = v.facility_id and n.valid_from > v.valid_from)
  and not exists (select 1 from history as n where n.facility_id = v.facility_id and n.valid_from = v.valid_to
    and n.valid_from = (select min(f.valid_from) from history as f where f.facility_id = v.facility_id and f.valid_from > v.valid_from))""")
def _(c):
    return tests.tiling_faults(c.history, "facility_id")


@query("test_history_tiling_broken", "K07 F09", """select v.facility_id, v.valid_from, v.valid_to, (select min(n.valid_from) from (select * from history where overall_rating is distinct from 3) as n where n.facility_id = v.facility_id and n.valid_from > v.valid_from) as next_from
  from (select * from history where overall_rating is distinct from 3) as v where v.valid_to <= v.valid_from or exists (select 1 from (select * from history where overall_rating is distinct from 3) as n where n.facility_id = v.facility_id and n.valid_from > v.valid_from)
  and not exists (select 1 from (select * from history where overall_rating is distinct from 3) as n where n.facility_id = v.facility_id and n.valid_from = v.valid_to
    and n.valid_from = (select min(f.valid_from) from (select * from history where overall_rating is distinct from 3) as f where f.facility_id = v.facility_id and f.valid_from > v.valid_from))""")
def _(c):
    return tests.tiling_faults(c.history.where(~F.col("overall_rating").eqNullSafe(3)), "facility_id")


@query("test_coverage", "K08 D09", """select coalesce(x.facility_id, s.facility_id) as facility_id,
  case when x.facility_id is null then 'left' else 'right' end as missing_from
  from (select facility_id from survey_wide where release_date = (select max(release_date) from survey_wide)) as x
  full outer join scorecard as s on s.facility_id = x.facility_id where x.facility_id is null or s.facility_id is null""")
def _(c):
    newest = c.experience.where(F.col("release_date") == gold.newest_release_of(c.experience))
    return tests.not_in_both(newest, c.scorecard, "facility_id")


@query("test_direction", "K09", f"""select * from (select domain, {oracle.mean('diff_from_national_median', 3)} as avg_diff from facts
  where comparison_category = 'better' and domain <> 'Uncatalogued' group by 1) as d where avg_diff > 0""")
def _(c):
    return tests.wrong_direction(c.facts, "domain", "diff_from_national_median")


@query("test_contract", "K10", """select 'as built' as version, 'facility_id' as "column", count(*) filter (where facility_id is null) as nulls, 0 as faults from dim
  union all select 'broken', 'facility_id', count(*) filter (where overall_rating = 3 or facility_id is null), 2 from dim""")
def _(c):
    """The dimension as built, and with ids lost, a column renamed and a column of another type."""
    dim = gold.dim_hospital(c.stg_hospitals, c.regions)
    broken = (dim.withColumn("facility_id", F.when(~F.col("overall_rating").eqNullSafe(3), F.col("facility_id")))
              .withColumn("overall_rating", F.col("overall_rating").cast("string")).withColumnRenamed("city", "town"))
    return reduce(DataFrame.unionByName, [
        tests.null_counts(df, DIM_HOSPITAL_CONTRACT).select(
            F.lit(name).alias("version"), "column", "nulls", F.lit(len(tests.contract_faults(df, DIM_HOSPITAL_CONTRACT))).alias("faults"))
        for name, df in (("as built", dim), ("broken", broken))])


# --- serving --------------------------------------------------------------------------
@query("national_kpis", "L01 E09", """select len(cards) as hospitals, len(rated) as rated,
  cast(list_sum(list_transform(rated, lambda c: c.overall_rating)) as double) / nullif(cast(len(rated) as double), 0) as avg_rating,
  100.0 * cast(len(list_filter(rated, lambda c: c.overall_rating in (4, 5))) as double) / nullif(len(rated), 0) as pct_top,
  len(list_filter(cards, lambda c: c.rating_change > 0)) as upgrades, len(list_filter(cards, lambda c: c.rating_change < 0)) as downgrades,
  100.0 * cast(list_sum(list_transform(cards, lambda c: c.measures_worse)) as double) / nullif(list_sum(list_transform(cards, lambda c: c.measures_rated)), 0) as pct_worse
  from (select cards, list_filter(cards, lambda c: c.overall_rating is not null) as rated from (select list(s) as cards from scorecard as s) as g) as h""")
def _(c):
    return serving.national_kpis(c.scorecard)


@query("rating_distribution", "L02 B29 E08", """select case ord when 0 then 'Not rated' else concat(ord, ' ★') end as label, cast(n as bigint) as n, ord from (
  select unnest(map_entries(histogram(coalesce(overall_rating, 0))), recursive := true) from scorecard) as h(ord, n)""")
def _(c):
    return serving.rating_distribution(c.scorecard)


@query("state_map", "L03 C08", "select * from states where rated_hospitals >= 5")
def _(c):
    return serving.state_map(c.states)


@query("ownership_balance", "L04 E10", f"""select g.ownership_group, n.hospitals, 100.0 * cast(n.better as double) / n.given as pct_better,
  100.0 * cast(n.worse as double) / n.given as pct_worse, n.avg_rating
  from (select distinct ownership_group from scorecard where measures_rated > 0) as g
  join (select ownership_group, count(*) as hospitals, sum(measures_better) as better, sum(measures_worse) as worse, sum(measures_rated) as given,
    {oracle.mean('overall_rating', 0)} as avg_rating from scorecard group by 1) as n on n.ownership_group is not distinct from g.ownership_group""")
def _(c):
    return serving.ownership_balance(c.scorecard)


_GLYPHS = "coalesce(repeat('★', {0}) || repeat('☆', 5 - {0}), '—')"


@query("explorer_table", "L05 C07 G02 B28", f"""select facility_id, facility_name, state, hospital_type, ownership_group,
  {_GLYPHS.format('overall_rating')} as rating,
  case when rating_change > 0 then '▲ ' || cast(rating_change as varchar) when rating_change < 0 then '▼ ' || cast(-rating_change as varchar) else '' end as rating_change,
  {_GLYPHS.format('patient_experience_star')} as px_star, outcome_composite, measures_better, measures_worse
  from scorecard where hospital_type in ('Acute Care Hospitals', 'Childrens') and ownership_group in ('Non-profit', 'Government') and overall_rating >= 2""")
def _(c):
    found = serving.explore(c.scorecard, types=["Acute Care Hospitals", "Childrens"], owners=["Non-profit", "Government"], min_rating=2)
    return serving.explorer_table(found)


@query("explorer_ranked", "G02 L05", """select s.facility_id, cast(1 + count(b.facility_id) as integer) as place from scorecard as s
  left join scorecard as b on (coalesce(b.outcome_composite, -1), coalesce(b.overall_rating, -1)) > (coalesce(s.outcome_composite, -1), coalesce(s.overall_rating, -1))
  group by 1""")
def _(c):
    return serving.placed(c.scorecard)


@query("facet_values", "L05 E11", """select 'state' as facet, state as value from scorecard where state is not null group by 2
  union all select 'hospital_type', hospital_type from scorecard where hospital_type is not null group by 2
  union all select 'ownership_group', ownership_group from scorecard where ownership_group is not null group by 2""")
def _(c):
    parts = [serving.facet_values(c.scorecard, f).select(F.lit(f).alias("facet"), F.col(f).alias("value"))
             for f in ("state", "hospital_type", "ownership_group")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("default_hospital", "L06 G03", """select * from scorecard order by (measures_rated >= 15 and patient_experience_star is not null) desc,
  outcome_composite desc nulls last, overall_rating desc nulls last, facility_id limit 1""")
def _(c):
    return serving.default_hospital(c.scorecard)


@query("hospital_measures", "L07 D07 C10 G05", f"""select own.* exclude (facility_id, release_date, source_dataset, compared_to_national, denominator,
    diff_from_national_median, period_start, period_end), names.measure_short_name, names.unit
  from (from facts where facility_id = '{ONE}' and performance_percentile between 0 and 100) as own
  join measures as names using (measure_id) where own.release_date in (select max(release_date) from facts)""")
def _(c):
    return serving.hospital_measures(c.facts, c.measures, ONE, newest=c.newest("facts"))


@query("hospital_survey", "L08 C10", f"""select *, coalesce({', '.join(serving.SHOWN_STARS)}) is not null as has_results from survey_wide
  where facility_id = '{ONE}' and release_date = (select max(release_date) from survey_wide)""")
def _(c):
    return serving.hospital_survey(c.experience, ONE, newest=c.newest("experience"))


@query("hospital_history", "L09 C10", f"""select valid_from, valid_to, overall_rating, ownership, hospital_type, is_current
  from history where facility_id = '{ONE}'""")
def _(c):
    return serving.hospital_history(c.history, ONE)


@query("latest_benchmarks", "L10 A16 G05", "select * from benchmarks where release_date = (select max(release_date) from benchmarks)")
def _(c):
    return serving.latest_benchmarks(c.benchmarks)


@query("reporting_states", "L11 D12 E11", "select distinct f.measure_id, d.state from facts as f join dim as d on d.facility_id = f.facility_id")
def _(c):
    return serving.reporting_states(c.facts, c.dim)


_BIN = """cast(least(floor(case when h.high > h.low then (s.score - h.low) / (h.high - h.low) else 0 end * 40.0), 39) as integer) + 1"""


@query("score_histogram", "L12 E14 D12", f"""select s.measure_id, {_BIN} as bin, count(*) as n, min(s.score) as low, max(s.score) as high
  from recent_scores as s join (select measure_id, min(score) as low, max(score) as high from recent_scores group by 1) as h
  on h.measure_id = s.measure_id group by 1, 2""")
def _(c):
    return serving.score_histogram(serving.current_scores(c.facts, c.dim, newest=c.newest("facts")))


@query("state_medians", "L13 E07 C08", """select measure_id, state, quantile_cont(score, 0.5) as median_score, count(*) as hospitals
  from recent_scores group by 1, 2 having count(*) >= 5""")
def _(c):
    return serving.state_medians(serving.current_scores(c.facts, c.dim, newest=c.newest("facts")))


@query("newest_release", "L19", "select max(release_date) as release_date from dim")
def _(c):
    return serving.newest_release(c.dim)


@query("rated_rows", "C05 E01", f"""select measure_id, release_date, count(*) filter (where score is not null and comparison_category in ({oracle.RATED})) as rated,
  count(*) as n from stg_measures group by 1, 2""")
def _(c):
    return c.stg_measures.groupBy("measure_id", "release_date").agg(
        F.count_if(labels.is_rated(F.col("score"), F.col("comparison_category"))).alias("rated"),
        F.count(F.lit(1)).alias("n"))
