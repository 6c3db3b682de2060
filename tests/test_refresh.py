"""From one refresh to the next: what is written, pointed to, tested, corrected and looked up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import dicts
from fixtures import HOSPITAL, bronze
from test_pipeline import FIRST, SECOND, land_all, written
from tidemark.operators import history as hist
from tidemark.plans import gold, model_tests, oplog, serving, silver
from tidemark.plans import refresh as job
from tidemark.plans.model_tests import ModelTest
from tidemark.sources import lake, landing, versions

THIRD = "2026-10-22"


def rows_of(tables, name):
    return sorted(map(repr, dicts(tables[name].drop("loaded_at"))))


def test_a_corrected_and_a_late_release_reach_every_table(spark, tmp_path):
    folders = job.Lake(str(tmp_path))
    land_all(spark, folders.root, SECOND, ["3"] * 5)
    land_all(spark, folders.root, THIRD, ["3", "4", "3", "3", "3", "1"])
    first = job.refresh(spark, folders.root, as_of="2026-08-01")
    assert land_all(spark, folders.root, SECOND, ["3"] * 5) == [False] * 4                  # the same content
    assert land_all(spark, folders.root, SECOND, ["5", "3", "3", "3", "3", "3"]) == [True] * 4   # another rating, one facility more
    land_all(spark, folders.root, FIRST, ["2", "3", "3", "3", "3"])                         # late
    second = job.refresh(spark, folders.root, as_of="2026-08-01")
    assert written(folders, "fct_measure_scores", second) == [f"release_date={FIRST}", f"release_date={SECOND}"]
    tables = versions.open_snapshot(spark, folders.marts)
    changes = sorted((r.facility_id, str(r.valid_from), r.rating_change) for r in tables["mart_rating_changes"].collect())
    assert changes == [("050000", SECOND, 3), ("050000", THIRD, -2), ("050001", THIRD, 1), ("050005", THIRD, -2)]
    assert tables["fct_measure_scores"].where(F.col("release_date") == SECOND).count() == 36
    old = versions.open_snapshot(spark, folders.marts, first)
    assert old["fct_measure_scores"].where(F.col("release_date") == SECOND).count() == 30
    whole = job.build_gold(spark, folders, "whole", full_refresh=True)
    again, newest = versions.open_snapshot(spark, folders.marts, "whole"), versions.open_snapshot(spark, folders.marts, second)
    assert all(rows_of(again, name) == rows_of(newest, name) for name in whole.schemas if not name.startswith("history_"))


def test_a_release_of_rejects_is_done(spark, tmp_path):
    folders = job.Lake(str(tmp_path))

    def land(release, facility):
        rows = bronze(spark, "hospital_info", [{**HOSPITAL, "facility_id": facility}]).drop("release_date", "_ingested_at")
        return job.land(spark, folders, "hospital_info", release, rows, "run-1", "files")

    def refresh():
        landed = landing.current_manifest(lake.read_table(spark, f"{folders.ops}/ingest_manifest"))
        return silver.refresh_silver(spark, folders.bronze, folders.silver, folders.quarantine, datasets=["hospital_info"], landed=landed)[0]

    assert land(FIRST, "050001") and land(SECOND, "bad")
    assert (refresh()["releases"], refresh()["releases"]) == ([FIRST, SECOND], [])
    assert job.Origins.read(spark, folders).releases("hospital_info") == [FIRST]
    assert not land(SECOND, "bad") and land(SECOND, "050002")
    assert refresh()["releases"] == [SECOND] and job.Origins.read(spark, folders).newest("hospital_info") == SECOND


def test_faulty_gold_is_not_published(spark, tmp_path, monkeypatch):
    folders = job.Lake(str(tmp_path))
    land_all(spark, folders.root, FIRST, ["3"] * 3)
    good = job.refresh(spark, folders.root, as_of="2026-08-01")
    right = gold.state_summary
    monkeypatch.setattr(gold, "state_summary", lambda card: right(card).unionByName(right(card)))
    land_all(spark, folders.root, SECOND, ["4"] * 3)
    with pytest.raises(model_tests.ModelTestError, match="mart_state_summary.unique_state"):
        job.refresh(spark, folders.root, as_of="2026-08-01")
    assert versions.newest_version(spark, folders.marts) == good
    assert versions.open_snapshot(spark, folders.marts)["dim_hospital_history"].where("valid_to is not null").count() == 0
    logs = versions.open_snapshot(spark, folders.published_ops)                          # the logs are there, also of the failed run
    assert sorted(r.status for r in logs["pipeline_runs"].collect()) == ["failed", "success"]
    results = logs["model_tests"].where(F.col("run_id") != good)
    assert results.count() == len(model_tests.MODEL_TESTS) and [r.test for r in results.where("grade = 'error'").collect()] == ["unique_state"]
    assert spark.sql("select count(*) from ingest_manifest").first()[0] == 8


def test_model_tests_one_by_one(spark):
    people = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (None, "c", 101.0)], "id int, kind string, score double")
    homes = spark.createDataFrame([(2,)], "id int")
    declared = [ModelTest("people", "unique", ("id",)), ModelTest("people", "not_null", ("id",)), ModelTest("people", "values", ("kind",), ("a", "b")),
                ModelTest("people", "range", ("score",), (0, 100), error_above=1), ModelTest("people", "relationship", ("id",), parent=("homes", "id"), error_above=None),
                ModelTest("people", "not_null", ("absent",)), ModelTest("nobody", "unique", ("id",), error_above=None), ModelTest("people", "coverage", ("id",), parent=("homes", "id"))]
    got = {(r.model, r.test): (r.offending, r.grade) for r in model_tests.run_model_tests(spark, {"people": people, "homes": homes}, declared).collect()}
    assert got == {("people", "unique_id"): (1, "error"), ("people", "not_null_id"): (1, "error"), ("people", "values_kind"): (1, "error"),
                   ("people", "range_score"): (1, "warn"), ("people", "relationship_id"): (2, "warn"), ("people", "not_null_absent"): (None, "error"),
                   ("nobody", "unique_id"): (None, "warn"), ("people", "coverage_id"): (4, "error")}
    empty = model_tests.run_model_tests(spark, {"people": people.where("false"), "homes": homes.where("false")}, declared[:5])
    assert {r.grade for r in empty.collect()} == {"pass"}


def test_a_run_left_open_is_closed(spark, tmp_path):
    folders = job.Lake(str(tmp_path))
    job.close_dead_runs(spark, folders)
    for name, age in (("dead", 3), ("alive", 0)):
        began = job.now() - dt.timedelta(days=age)
        oplog.append(oplog.run_event(spark, name, "files", "manual", "running", began), folders.ops, "pipeline_runs")
    job.close_dead_runs(spark, folders)
    states = {r.run_id: r.status for r in oplog.run_states(oplog.read_log(spark, folders.ops, "pipeline_runs")).collect()}
    assert states == {"dead": "failed", "alive": "running"}


def test_merges_equal_the_whole_history(spark):
    """Four releases in which facilities come, change, vanish and return, arriving in turn and late."""
    rows = [("a", 3, 1), ("a", 3, 2), ("a", 4, 3), ("a", 4, 4), ("b", 5, 1), ("b", 5, 3), ("c", None, 2), ("c", 1, 3), ("d", 2, 4), ("e", 2, 1), ("e", 1, 2)]
    full = [(k, f"N{k}", "CA", "T", "O", "G", r, True, False, dt.date(2026, m, 1)) for k, r, m in rows]
    stg = spark.createDataFrame(full, "facility_id string, facility_name string, state string, hospital_type string, ownership string, ownership_group string, "
                                      "overall_rating int, has_emergency_services boolean, is_birthing_friendly boolean, release_date date")
    days = [f"2026-0{m}-01" for m in (1, 2, 3, 4)]

    def of(some):
        return stg.where(F.col("release_date").cast("string").isin(some))

    def plain(df):
        return sorted((r.facility_id, r.valid_from, r.valid_to, r.overall_rating, r.hospital_version_key) for r in df.collect())

    for order in ([0, 2, 3, 1], [1, 3, 0, 2]):
        kept, seen = None, []
        for k in order:
            late = any(days[k] < d for d in seen)
            seen.append(days[k])
            if late:
                kept = gold.reopen_releases(kept, of(seen), [days[k]])
            else:
                new = gold.merge_releases(kept, of([days[k]]))
                kept = gold.History(kept.closed.unionByName(new.closed), new.latest) if kept else new
            kept = gold.History(spark.createDataFrame(kept.closed.collect(), kept.closed.schema), spark.createDataFrame(kept.latest.collect(), kept.latest.schema))
            assert plain(kept.versions(of(seen).select("release_date"))) == plain(gold.hospital_versions(of(seen)))
    assert hist.tiling_faults(kept.versions(stg.select("release_date")), "facility_id").isEmpty()


def test_a_lookup_skips_row_groups(spark, tmp_path):
    """A published table clustered by facility: a lookup of one reads a small share of its rows."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "65536")
    try:
        rows = spark.range(200_000).select(
            F.format_string("%06d", F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("facility_id"), F.concat(F.lit("M"), (F.col("id") % 20).cast("string")).alias("measure_id"),
            F.rand(3).alias("score"), F.lit("mortality").alias("domain"), F.lit("better").alias("comparison_category"), F.rand(4).alias("lower_estimate"),
            F.rand(5).alias("higher_estimate"), F.rand(6).alias("national_median"), F.rand(7).alias("performance_percentile"),
            F.when(F.col("id") % 2 == 0, FIRST).otherwise(SECOND).cast("date").alias("release_date"))
        out = versions.Snapshot(spark, str(tmp_path), "v1")
        facts = out.put("fct_measure_scores", rows, release="release_date", cluster="facility_id")
        out.commit()
    finally:
        conf.unset("parquet.block.size")
    entry = versions.read_version(spark, str(tmp_path))
    names = spark.createDataFrame([(f"M{k}", f"M{k}", "percent") for k in range(20)], "measure_id string, measure_short_name string, unit string")
    newest = facts.where(F.col("release_date") == F.lit(entry.releases("fct_measure_scores")[-1]).cast("date"))
    mine = newest.where("facility_id = '000123'")
    found = mine.collect()
    scan = mine._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert len(found) == newest.where("concat(facility_id, '') = '000123'").count() > 0
    assert len(found) <= read < 100_000 / 10
    assert serving.hospital_measures(facts, names, "000123").count() == len(found)


def test_folders_and_versions_without_data(spark, tmp_path):
    assert lake.partition_folders(spark, str(tmp_path / "none")) == []
    empty = spark.createDataFrame([], "facility_id string, release_date date")
    out = versions.Snapshot(spark, str(tmp_path), "v1")
    out.put("facts", empty, release="release_date", origins={FIRST: "x"})
    out.put("dim", empty.drop("release_date"))
    entry = out.commit()
    tables = versions.open_snapshot(spark, str(tmp_path))
    assert entry.rows == {"facts": 0, "dim": 0} and entry.releases("facts") == [] and tables["facts"].count() == tables["dim"].count() == 0
    later = versions.Snapshot(spark, str(tmp_path), "v2")
    assert later.stale("facts", {FIRST: "x"}) == [] and later.stale("facts", {FIRST: "y", SECOND: "x"}) == [FIRST, SECOND]
