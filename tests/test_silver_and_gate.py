import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import dicts
from fixtures import HOSPITAL, MEASURE, SURVEY, bronze
from tidemark.plans import gate, silver


def test_clean_hospital(spark):
    parts = silver.silver_parts(bronze(spark, "hospital_info", [
        HOSPITAL, {**HOSPITAL, "facility_id": "050002", "hospital_overall_rating": "Not Available"}]), "hospital_info")
    rows = {r["facility_id"]: r for r in dicts(parts.rows)}
    first = rows["050001"]
    assert first["facility_name"] == "Riverbend County Clinic" and first["zip_code"] == "00607"
    assert first["overall_rating"] == 4 and first["has_emergency_services"] and first["is_birthing_friendly"]
    assert first["mort_measures_better"] is None and first["overall_rating_footnote"] is None
    assert rows["050002"]["overall_rating"] is None and parts.bad.isEmpty()
    assert len(parts.rows.columns) == 25


def test_quarantine(spark):
    parts = silver.silver_parts(bronze(spark, "hospital_info", [
        HOSPITAL, {**HOSPITAL, "facility_id": "12AB"}, {**HOSPITAL, "facility_id": "050003", "state": "ZZ"},
        {**HOSPITAL, "facility_id": "", "state": "ZZ"}]), "hospital_info")
    assert {r.facility_id: r._reject_reason for r in parts.bad.collect()} == {
        "12AB": "invalid_facility_id", "050003": "invalid_state", None: "invalid_facility_id;invalid_state"}
    assert parts.good.count() == 1
    assert parts.stats.first().asDict() == {"rows_in": 4, "quarantined": 3, "unparseable_numerics": 0}


def test_measures(spark):
    parts = silver.silver_parts(bronze(spark, "complications_deaths", [
        MEASURE, {**MEASURE, "measure_id": "PSI_90", "score": "12..4", "end_date": "not a date"},
        {**MEASURE, "facility_id": "bad", "score": "x"}]), "complications_deaths")
    rows = {r["measure_id"]: r for r in dicts(parts.rows)}
    assert rows["MORT_30_AMI"]["denominator"] == 2560.0 and rows["MORT_30_AMI"]["period_end"] == dt.date(2024, 9, 30)
    assert rows["PSI_90"]["score"] is None and rows["PSI_90"]["period_end"] is None
    assert rows["PSI_90"]["number_of_patients"] is None and rows["PSI_90"]["source_dataset"] == "complications_deaths"
    assert parts.stats.first().unparseable_numerics == 1
    assert len(parts.rows.columns) == 16


def test_measures_dedupe_runs_per_feed(spark):
    feeds = {n: bronze(spark, n, [MEASURE, {**MEASURE, "_ingested_at": "2026-01-03", "score": "9"}])
             for n in ("complications_deaths", "unplanned_visits")}
    both = silver.silver_measures(feeds)
    assert sorted((r.source_dataset, r.score) for r in both.collect()) == [("complications_deaths", 9.0), ("unplanned_visits", 9.0)]
    assert gate.repeated_keys("measure_scores", both).first().repeated_keys == 1


def silver_tables(spark, hospitals=None):
    return {
        "hospitals": silver.silver_hospitals(bronze(spark, "hospital_info", hospitals or [HOSPITAL, {**HOSPITAL, "facility_id": "050002"}])),
        "measure_scores": silver.silver_measures({"complications_deaths": bronze(spark, "complications_deaths", [
            MEASURE, {**MEASURE, "facility_id": "050002"}])}),
        "hcahps": silver.silver_survey(bronze(spark, "hcahps", [SURVEY]))}


def test_gate_passes_clean_tables(spark):
    results = gate.run_checks(silver_tables(spark), "2026-02-01")
    rows = dicts(results)
    assert len(rows) == 23 and all(r["passed"] for r in rows), [r for r in rows if not r["passed"]]
    gate.enforce(results)


def test_gate_stops_on_duplicates_and_ranges(spark):
    tables = silver_tables(spark, [{**HOSPITAL, "hospital_overall_rating": "9"}])
    tables["hospitals"] = tables["hospitals"].unionByName(tables["hospitals"])
    results = gate.run_checks(tables, "2026-02-01")
    with pytest.raises(gate.QualityError, match="business_key_unique.*overall_rating_in_range"):
        gate.enforce(results)


def test_gate_reports_missing_columns_and_goes_on(spark):
    tables = silver_tables(spark)
    tables["hospitals"] = tables["hospitals"].drop("overall_rating")
    rows = dicts(gate.run_checks(tables, "2026-02-01"))
    failed = {(r["dataset"], r["check_name"], r["observed"]) for r in rows if not r["passed"]}
    assert len(rows) == 23 and failed == {("hospitals", "schema_contract", "overall_rating"), ("hospitals", "overall_rating_in_range", "did not run"),
                                          ("hospitals", "overall_rating_null_pct", "did not run")}


def test_column_of_another_type_fails_its_own_checks_only(spark):
    tables = silver_tables(spark)
    as_text = tables["hospitals"].withColumn("overall_rating", F.col("overall_rating").cast("string"))
    failed = {(r["dataset"], r["check_name"]): r["observed"] for r in dicts(gate.run_checks({**tables, "hospitals": as_text}, "2026-02-01")) if not r["passed"]}
    assert failed == {("hospitals", "schema_contract"): "overall_rating is string, not int"}
    broken = tables["hospitals"].withColumn("overall_rating", F.lit("four"))       # breaks while it runs
    rows = {(r["dataset"], r["check_name"]): r for r in dicts(gate.run_checks({**tables, "hospitals": broken}, "2026-02-01")) if not r["passed"]}
    assert set(rows) == {("hospitals", "schema_contract"), ("hospitals", "overall_rating_in_range")}
    assert "CAST_INVALID_INPUT" in rows["hospitals", "overall_rating_in_range"]["message"]


def test_ledger_counts_only_what_was_written(spark):
    """Counts of one release replaced in a ledger of two: the same checks as from all rows, also when faults are gone."""
    def tables(second):
        return silver_tables(spark, [{**HOSPITAL, "release_date": "2025-10-01"}, second])

    bad = tables({**HOSPITAL, "hospital_overall_rating": "9"})
    bad["hospitals"] = bad["hospitals"].unionByName(bad["hospitals"].where("overall_rating = 9"))
    log = gate.measure(spark, bad)
    good = tables({**HOSPITAL, "hospital_overall_rating": "5"})
    newest = "2026-01-01"
    recounted = gate.measure(spark, good, {"hospitals": [newest]})
    assert {r.release_date for r in recounted.collect()} == {newest}
    ledger = gate.current_ledger(log.unionByName(recounted))
    plain = {(r["dataset"], r["check_name"]): (r["passed"], r["observed"]) for r in dicts(gate.run_checks(good, "2026-02-01"))}
    assert {(r["dataset"], r["check_name"]): (r["passed"], r["observed"]) for r in dicts(gate.run_checks(good, "2026-02-01", ledger=ledger))} == plain
    assert plain["hospitals", "business_key_unique"] == plain["hospitals", "overall_rating_in_range"] == (True, "0.000")


def test_empty_table_fails_only_on_rows(spark):
    tables = silver_tables(spark)
    tables["hcahps"] = tables["hcahps"].where("false")
    failed = {(r["dataset"], r["check_name"]) for r in dicts(gate.run_checks(tables, "2026-02-01")) if not r["passed"]}
    assert failed == {("hcahps", "row_count_positive")}


def test_volume_swing_and_age(spark):
    rows = [{**HOSPITAL, "facility_id": f"05000{i}", "release_date": "2026-04-01"} for i in range(4)] + [HOSPITAL]
    failed = {r["check_name"]: r["observed"] for r in dicts(gate.table_checks("hospitals", gate.measure(spark, silver_tables(spark, rows)), "2027-04-01"))
              if not r["passed"]}
    assert failed == {"release_volume_change_pct": "300.000", "freshness_days": "365.000"}


@pytest.mark.parametrize(("rejected", "severity", "passed"), [(1, "warn", True), (3, "warn", False), (6, "error", False)])
def test_quarantine_rate(spark, rejected, severity, passed):
    stats = [{"table": "hospitals<-hospital_info", "rows_in": 100, "quarantined": rejected, "duplicates_removed": 0},
             {"table": "hcahps<-hcahps", "rows_in": 0, "quarantined": 0, "duplicates_removed": 0}]
    rows = dicts(gate.quarantine_checks(spark, stats))
    assert [(r["severity"], r["passed"]) for r in rows] == [(severity, passed)]
