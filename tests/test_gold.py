import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import dicts
from fixtures import HOSPITAL, MEASURE, bronze
from tidemark.operators import tests
from tidemark.plans import gold, serving, silver
from tidemark.sources.feeds import DIM_HOSPITAL_CONTRACT, measure_catalog, state_regions


def scorecard_inputs(spark):
    facts = spark.createDataFrame(
        [("H1", "M1", "Mortality", "better", 90.0), ("H1", "M2", "Mortality", "no_different", 80.0),
         ("H1", "M3", "Readmission", "no_different", 70.0), ("H1", "M4", "Readmission", "no_different", 70.0),
         ("H1", "M5", "Patient safety", "better", 90.0), ("H2", "M1", "Mortality", "worse", 10.0)],
        "facility_id string, measure_id string, domain string, comparison_category string, performance_percentile double")
    facts = facts.withColumn("release_date", F.lit("2026-07-01").cast("date")).withColumn("source_dataset", F.lit("a"))
    names = [f.name for f in DIM_HOSPITAL_CONTRACT.fields]
    rows = [{"facility_id": "H1", "state": "CA", "overall_rating": 5}, {"facility_id": "H2", "state": "CA", "overall_rating": 2}]
    dim = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], DIM_HOSPITAL_CONTRACT)
    stg = spark.createDataFrame([("H1", 4, "2026-04-01"), ("H1", 5, "2026-07-01")], "facility_id string, overall_rating int, release_date string")
    experience = spark.createDataFrame([("H1", "2026-07-01", 4, None, None)],
                                       "facility_id string, release_date string, summary_star int, pct_definitely_recommend int, completed_surveys int")
    return dim, facts, experience, stg.withColumn("release_date", F.col("release_date").cast("date"))


def test_scorecard_needs_five_rated_measures(spark):
    rows = {r["facility_id"]: r for r in dicts(gold.hospital_scorecard(*scorecard_inputs(spark)))}
    one, two = rows["H1"], rows["H2"]
    assert (one["outcome_composite"], one["outcome_tier"], one["measures_better"], one["measures_worse"], one["rating_change"]) == \
        (80.0, "High performer", 2, 0, 1)
    assert (two["outcome_composite"], two["outcome_tier"], two["measures_better"], two["measures_worse"], two["rating_change"]) == \
        (None, "Insufficient data", 0, 1, None)
    assert one["state_rank"] == 1 and two["state_rank"] is None and one["mortality_percentile"] == 85.0


def test_state_without_rated_hospitals(spark):
    dim, facts, experience, stg = scorecard_inputs(spark)
    card = gold.hospital_scorecard(dim.withColumn("overall_rating", F.lit(None).cast("int")), facts.where("false"), experience, stg)
    row = dicts(gold.state_summary(card))[0]
    assert row["hospitals"] == 2 and row["rated_hospitals"] == 0
    assert row["avg_overall_rating"] is None and row["pct_4_or_5_star"] is None and row["pct_measures_worse"] is None
    kpis = dicts(serving.national_kpis(card))[0]
    assert kpis["pct_top"] is None and kpis["pct_worse"] is None


def staged_scores(spark, rows):
    full = [{**MEASURE, **r} for r in rows]
    feeds = {n: bronze(spark, n, [r for r in full if r.get("feed", "complications_deaths") == n] or [{**MEASURE, "facility_id": "x"}])
             for n in ("complications_deaths", "unplanned_visits")}
    return gold.stg_measure_scores(silver.silver_measures({n: df.drop("feed") for n, df in feeds.items()}))


def test_benchmarks_over_rated_rows_only(spark):
    stg = staged_scores(spark, [
        {"facility_id": "000001", "score": "10"}, {"facility_id": "000002", "score": "20"}, {"facility_id": "000003", "score": "30"},
        {"facility_id": "000004", "score": "5", "compared_to_national": "Number of Cases Too Small"},
        {"facility_id": "000005", "score": "Not Available"},
        {"facility_id": "000001", "measure_id": "UNKNOWN", "score": "7"}])
    rows = {(r["facility_id"], r["measure_id"]): r for r in dicts(gold.benchmark_scores(stg, measure_catalog(spark)))}
    assert len(rows) == 6
    assert [rows[(f"00000{i}", "MORT_30_AMI")]["performance_percentile"] for i in range(1, 6)] == [100.0, 50.0, 0.0, None, None]
    assert rows[("000001", "MORT_30_AMI")]["national_median"] == 20.0
    assert rows[("000001", "MORT_30_AMI")]["diff_from_national_median"] == -10.0
    assert rows[("000004", "MORT_30_AMI")]["national_median"] is None
    alone = rows[("000001", "UNKNOWN")]
    assert alone["performance_percentile"] == 100.0 and alone["domain"] is None and alone["lower_is_better"] is True


def test_higher_is_better(spark):
    catalog = measure_catalog(spark).withColumn("lower_is_better", F.lit(False))
    stg = staged_scores(spark, [{"facility_id": "000001", "score": "10"}, {"facility_id": "000002", "score": "20"}])
    got = {r.facility_id: r.performance_percentile for r in gold.benchmark_scores(stg, catalog).collect()}
    assert got == {"000001": 0.0, "000002": 100.0}


def test_unknown_measure_in_dimension(spark):
    row = dicts(gold.dim_measure(staged_scores(spark, [{"facility_id": "000001", "measure_id": "UNKNOWN"}]), measure_catalog(spark)))[0]
    assert (row["domain"], row["measure_short_name"], row["unit"]) == ("Uncatalogued", "Death rate", None)


def test_late_feed_with_an_older_date_is_loaded(spark):
    stg = staged_scores(spark, [
        {"facility_id": "000001", "release_date": "2026-07-01"},
        {"facility_id": "000001", "release_date": "2026-04-01", "feed": "unplanned_visits", "measure_id": "OP_36"},
        {"facility_id": "000002", "release_date": "2026-04-01", "feed": "unplanned_visits", "measure_id": "OP_36", "score": "99"}])
    catalog = measure_catalog(spark)
    everything = gold.fct_measure_scores(stg, catalog)
    loaded = everything.where("source_dataset = 'complications_deaths'")
    assert gold.fct_measure_scores(stg, catalog, loaded, by="newest").count() == 0
    late = gold.fct_measure_scores(stg, catalog, loaded, by="feed")
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, everything.where("source_dataset = 'unplanned_visits'").collect()))
    assert late.count() == 2


def test_dimension_contract(spark):
    stg = gold.stg_hospitals(silver.silver_hospitals(bronze(spark, "hospital_info", [HOSPITAL, {**HOSPITAL, "release_date": "2025-01-01"}])))
    dim = gold.dim_hospital(stg, state_regions(spark))
    assert tests.contract_faults(dim, DIM_HOSPITAL_CONTRACT) == []
    assert tests.contract_faults(dim.drop("city"), DIM_HOSPITAL_CONTRACT)
    lost = dim.unionByName(dim.withColumn("facility_id", F.lit(None).cast("string")))
    assert [tuple(r) for r in tests.null_counts(lost, DIM_HOSPITAL_CONTRACT).collect()] == [("facility_id", 1)]
    row = dicts(dim)[0]
    assert dim.count() == 1 and row["census_region"] == "West" and row["release_date"] == dt.date(2026, 1, 1)


def test_releases_at_once_or_one_by_one(spark):
    """History from all releases equals history from any order of arrival."""
    rows = [{**HOSPITAL, "release_date": d, "hospital_overall_rating": r}
            for d, r in (("2026-01-01", "3"), ("2026-04-01", "3"), ("2026-07-01", "4"), ("2026-10-01", "NA"))]
    once = gold.hospital_versions(gold.stg_hospitals(silver.silver_hospitals(bronze(spark, "hospital_info", rows))))
    parts = [silver.silver_hospitals(bronze(spark, "hospital_info", [r])) for r in rows[::-1]]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    again = gold.hospital_versions(gold.stg_hospitals(stacked))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect())) and once.count() == 3


@pytest.mark.parametrize("parts", [1, 8])
def test_explorer(spark, parts):
    card = gold.hospital_scorecard(*scorecard_inputs(spark)).withColumn("hospital_type", F.lit("T")).withColumn("ownership_group", F.lit("Other"))
    card = card.repartition(parts)
    assert [r.facility_id for r in serving.explorer_table(serving.explore(card, state="CA", types=["T"], owners=["Other"])).collect()] == ["H1", "H2"]
    assert serving.explore(card, min_rating=3).count() == 1
    assert serving.default_hospital(card).first().facility_id == "H1"
