import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import dicts
from fixtures import HOSPITAL, MEASURE, SURVEY, bronze
from tidemark.plans import gate, oplog, serving
from tidemark.plans import refresh as job
from tidemark.plans.silver import refresh_silver
from tidemark.sources import lake, landing, versions
from tidemark.sources.feeds import CATALOG_SCHEMA, measure_catalog, read_lookup_csv, state_regions
from tidemark.streaming.pickup import pick_up

FIRST, SECOND = "2026-04-22", "2026-07-22"


# --- landing ---------------------------------------------------------------------------
def write_pages(folder, pages):
    for i, page in enumerate(pages):
        (folder / f"page-{i}.json").write_text(json.dumps(page))


def test_pages_in_order_with_all_fields_as_text(spark, tmp_path):
    rows = [{"id": i, **({"extra": True} if i == 4 else {})} for i in range(5)]
    write_pages(tmp_path, [{"offset": o, "count": 5, "results": rows[o:o + 2]} for o in (0, 2, 4)])
    pages = landing.read_pages(spark, str(tmp_path))
    got = landing.land_pages(pages)
    assert sorted((r.id, r.extra) for r in got.collect()) == [("0", None), ("1", None), ("2", None), ("3", None), ("4", "true")]
    assert landing.page_totals(pages).first().asDict() == {"rows_landed": 5, "rows_announced": 5, "is_complete": True}


def test_an_empty_page_ends_the_feed(spark, tmp_path):
    write_pages(tmp_path, [{"offset": 0, "count": 100, "results": [{"id": "a"}]}, {"offset": 1, "count": 100, "results": []},
                           {"offset": 2, "count": 100, "results": [{"id": "late"}]}])
    pages = landing.read_pages(spark, str(tmp_path))
    assert [r.id for r in landing.land_pages(pages).collect()] == ["a"]
    assert landing.page_totals(pages).first().is_complete is False


def test_release_of_falls_back_to_today(spark):
    df = spark.createDataFrame([("2026-07-22T10:00",), ("",), (None,)], "m string")
    assert [r[0] for r in df.select(landing.release_of(F.col("m"), F.lit("2030-01-01"))).collect()] == ["2026-07-22", "2030-01-01", "2030-01-01"]


def test_new_releases(spark):
    there = spark.createDataFrame([("a", FIRST, "1"), ("a", SECOND, "2")], "dataset string, release_date string, content_sum string")
    manifest = spark.createDataFrame([("a", FIRST, "other")], "dataset string, release_date string, content_sum string")
    assert [r.release_date for r in landing.new_releases(there, manifest).collect()] == [SECOND]
    assert landing.new_releases(there, manifest, force=True).count() == 2
    assert landing.new_releases(there, manifest, notice_corrections=True).count() == 2


def test_empty_feed_is_refused_and_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    with pytest.raises(landing.EmptyFeedError):
        landing.land_release(empty, str(tmp_path / "bronze"), "hcahps", FIRST)
    assert not (tmp_path / "bronze").exists()


def test_manifest_keeps_the_newest_entry(spark):
    log = spark.createDataFrame([("r1", "a", FIRST, 5, "x", "p", dt.datetime(2026, 1, 1)), ("r2", "a", FIRST, 7, "y", "p", dt.datetime(2026, 1, 2))],
                                landing.MANIFEST_SCHEMA)
    assert [(r.run_id, r.rows) for r in landing.current_manifest(log).collect()] == [("r2", 7)]


def test_lookup_from_csv(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text("measure_id,measure_short_name,domain,lower_is_better,unit\nM1,One,Mortality,false,percent\n")
    row = read_lookup_csv(spark, str(path), CATALOG_SCHEMA).first()
    assert row.lower_is_better is False and row.unit == "percent"


def test_lookups_are_complete_and_small_enough_to_broadcast(spark):
    assert state_regions(spark).count() == 56 and measure_catalog(spark).count() == 34
    plan = spark.range(10).select(F.col("id").cast("string").alias("state")).join(state_regions(spark), "state", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


# --- silver job ------------------------------------------------------------------------
def write_bronze(spark, root, dataset, rows):
    lake.write_partitions(bronze(spark, dataset, rows), f"{root}/bronze/{dataset}", ["release_date"])


def run_silver(spark, root, **more):
    return {s["table"]: s for s in refresh_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", **more)}


def test_only_new_releases_are_processed(spark, tmp_path):
    root = str(tmp_path)
    write_bronze(spark, root, "hospital_info", [{**HOSPITAL, "release_date": FIRST}, {**HOSPITAL, "release_date": FIRST},
                                                {**HOSPITAL, "facility_id": "bad", "release_date": FIRST}])
    one = run_silver(spark, root, datasets=["hospital_info"])["hospitals<-hospital_info"]
    assert (one["releases"], one["rows_in"], one["rows_out"], one["quarantined"], one["duplicates_removed"]) == ([FIRST], 3, 1, 1, 1)
    write_bronze(spark, root, "hospital_info", [{**HOSPITAL, "release_date": SECOND}])
    two = run_silver(spark, root, datasets=["hospital_info"])["hospitals<-hospital_info"]
    assert (two["releases"], two["rows_out"]) == ([SECOND], 1)
    assert run_silver(spark, root, datasets=["hospital_info"])["hospitals<-hospital_info"]["releases"] == []
    assert lake.read_table(spark, f"{root}/silver/hospitals").count() == 2


def test_a_clean_rerun_clears_old_rejects(spark, tmp_path):
    root = str(tmp_path)
    write_bronze(spark, root, "hospital_info", [{**HOSPITAL, "release_date": FIRST}, {**HOSPITAL, "facility_id": "bad", "release_date": FIRST}])
    run_silver(spark, root, datasets=["hospital_info"])
    assert lake.read_quarantine(spark, f"{root}/quarantine/hospital_info").count() == 1
    write_bronze(spark, root, "hospital_info", [{**HOSPITAL, "release_date": FIRST}])
    run_silver(spark, root, datasets=["hospital_info"], full_refresh=True)
    assert lake.read_quarantine(spark, f"{root}/quarantine/hospital_info").count() == 0


def test_release_with_only_rejects(spark, tmp_path):
    root = str(tmp_path)
    write_bronze(spark, root, "hospital_info", [{**HOSPITAL, "facility_id": "bad", "release_date": FIRST}])
    stats = run_silver(spark, root, datasets=["hospital_info"])["hospitals<-hospital_info"]
    assert (stats["rows_in"], stats["quarantined"], stats["rows_out"]) == (1, 1, 0)


def test_rejecting_a_whole_release_later_removes_its_old_rows(spark, tmp_path):
    root = str(tmp_path)
    write_bronze(spark, root, "unplanned_visits", [{**MEASURE, "release_date": FIRST}, {**MEASURE, "release_date": SECOND}])
    run_silver(spark, root, datasets=["unplanned_visits"])
    write_bronze(spark, root, "unplanned_visits", [{**MEASURE, "facility_id": "bad", "release_date": FIRST}])
    stats = run_silver(spark, root, datasets=["unplanned_visits"], full_refresh=True)["measure_scores<-unplanned_visits"]
    assert (stats["rows_in"], stats["quarantined"], stats["rows_out"], stats["duplicates_removed"]) == (2, 1, 1, 0)
    assert [r.release_date for r in lake.read_table(spark, f"{root}/silver/measure_scores").collect()] == [SECOND]


def test_columns_that_appear_in_a_later_release(spark, tmp_path):
    root = str(tmp_path)
    write_bronze(spark, root, "complications_deaths", [{**MEASURE, "release_date": FIRST}])
    write_bronze(spark, root, "complications_deaths", [{**MEASURE, "release_date": SECOND, "number_of_patients": "12"}])
    run_silver(spark, root, datasets=["complications_deaths"])
    got = {r.release_date: r.number_of_patients for r in lake.read_table(spark, f"{root}/silver/measure_scores").collect()}
    assert got == {FIRST: None, SECOND: 12}


def test_stream_completes_a_release_that_arrives_in_parts(spark, tmp_path):
    root = str(tmp_path)
    path = f"{root}/bronze/hospital_info"

    def arrive(rows):
        bronze(spark, "hospital_info", rows).write.mode("append").partitionBy("release_date").parquet(path)
        pick_up(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", "hospital_info", f"{root}/state").awaitTermination()
        return lake.read_table(spark, f"{root}/silver/hospitals").count()

    assert arrive([{**HOSPITAL, "release_date": FIRST}]) == 1
    assert arrive([{**HOSPITAL, "facility_id": "050002", "release_date": FIRST}, {**HOSPITAL, "release_date": SECOND}]) == 3
    assert arrive([{**HOSPITAL, "release_date": FIRST}]) == 3


# --- whole refresh ---------------------------------------------------------------------
def land_all(spark, root, release, ratings, force=False):
    folders = job.Lake(root)
    ids = [f"05{i:04d}" for i in range(len(ratings))]
    categories = ["Better Than the National Rate", "No Different Than the National Rate", "Worse Than the National Rate"]
    measures = ["MORT_30_AMI", "MORT_30_HF", "READM_30_HF", "PSI_90", "PSI_03_ULCER", "OP_36"]
    feeds = {
        "hospital_info": [{**HOSPITAL, "facility_id": f, "hospital_overall_rating": r} for f, r in zip(ids, ratings, strict=True)],
        "complications_deaths": [{**MEASURE, "facility_id": f, "measure_id": m, "score": str(10 + i + j), "compared_to_national": categories[i % 3]}
                                 for i, f in enumerate(ids) for j, m in enumerate(measures[:5])],
        "unplanned_visits": [{**MEASURE, "facility_id": f, "measure_id": "OP_36", "score": str(i)} for i, f in enumerate(ids)],
        "hcahps": [{**SURVEY, "facility_id": f} for f in ids]}
    return [job.land(spark, folders, name, release, bronze(spark, name, rows).drop("release_date", "_ingested_at"), "run-0", "files", force)
            for name, rows in feeds.items()]


def written(folders, table, version):
    """Folders with data files that a version wrote for a table."""
    top = f"{folders.marts}/data/{table}/written={version}"
    return sorted(os.path.relpath(d, top) for d, _, names in os.walk(top) if any(n.endswith(".parquet") for n in names))


def test_two_releases_end_to_end(spark, tmp_path):
    root, folders = str(tmp_path), job.Lake(str(tmp_path))
    assert land_all(spark, root, FIRST, ["3"] * 8) == [True] * 4
    assert land_all(spark, root, FIRST, ["3"] * 8) == [False] * 4
    first = job.refresh(spark, root, as_of="2026-08-01")
    facts_before = versions.open_snapshot(spark, folders.marts)["fct_measure_scores"].count()
    assert land_all(spark, root, SECOND, ["4", "2"] + ["3"] * 6) == [True] * 4
    second = job.refresh(spark, root, as_of="2026-08-01")
    assert versions.newest_version(spark, folders.marts) == second != first
    tables = versions.open_snapshot(spark, folders.marts)
    assert tables["mart_hospital_scorecard"].count() == tables["dim_hospital"].count() == 8
    history = tables["dim_hospital_history"]
    assert history.count() == 10 and history.where("is_current").count() == 8
    assert tables["fct_measure_scores"].count() == 2 * facts_before == 96
    assert sorted((r.facility_id, r.rating_change) for r in tables["mart_rating_changes"].collect()) == [("050000", 1), ("050001", -1)]
    assert spark.sql("select count(*) from mart_state_summary where state = 'CA'").first()[0] == 1

    for table in ("fct_measure_scores", "score_counts", "fct_patient_experience", "benchmark_numbers"):
        assert written(folders, table, first) == [f"release_date={FIRST}"] and written(folders, table, second) == [f"release_date={SECOND}"]
    entry = versions.read_version(spark, folders.marts)
    assert entry.version == second and entry.releases("fct_measure_scores") == [FIRST, SECOND] and entry.rows["fct_measure_scores"] == 96

    third = job.refresh(spark, root, as_of="2026-08-01")     # nothing new: all releases are pointed to
    assert written(folders, "fct_measure_scores", third) == []
    assert versions.read_version(spark, folders.marts).of("fct_measure_scores") == entry.of("fct_measure_scores")
    gone = versions.unreferenced(spark, folders.marts, [second, third])
    assert gone and not any(p.folder in gone for p in entry.parts) and not any("fct_measure_scores" in g for g in gone)
    with pytest.raises(ValueError, match="is published"):     # a published version is not written again
        versions.Snapshot(spark, folders.marts, first)
    again = versions.open_snapshot(spark, folders.marts)
    assert again["fct_measure_scores"].count() == 96
    old = versions.open_snapshot(spark, folders.marts, first)     # an earlier version stays readable
    assert old["fct_measure_scores"].count() == facts_before

    runs = oplog.run_states(oplog.read_log(spark, folders.ops, "pipeline_runs"))
    assert {r.run_id: r.status for r in runs.collect()} == dict.fromkeys((first, second, third), "success")
    tasks = oplog.read_log(spark, folders.ops, "task_runs")
    per_table = {r["table"]: r["rows_out"] for r in dicts(oplog.task_tables(tasks, "silver"))}
    assert per_table["hospitals<-hospital_info"] == 8 and per_table["hcahps<-hcahps"] == 8
    results = oplog.latest_check_results(oplog.read_log(spark, folders.ops, "dq_results"))
    assert serving.check_summary(results).first().asDict() == {"passed": 23, "warnings": 0, "blocking": 0, "checks": 23}
    manifest = landing.current_manifest(oplog.read_log(spark, folders.ops, "ingest_manifest"))
    assert manifest.count() == 8 and serving.bronze_volume(manifest).count() == 2
    layers = {r["layer"]: r["rows"] for r in dicts(serving.layer_totals(manifest, oplog.task_tables(tasks, "silver"), versions.published(spark, folders.marts)))}
    assert layers["bronze"] == 2 * 64 and layers["silver"] == 64


def test_a_blocked_run_publishes_nothing(spark, tmp_path):
    root, folders = str(tmp_path), job.Lake(str(tmp_path))
    land_all(spark, root, FIRST, ["3"] * 4)
    good = job.refresh(spark, root, as_of="2026-05-01")
    land_all(spark, root, SECOND, ["9"] * 4)
    with pytest.raises(gate.QualityError, match="overall_rating_in_range"):
        job.refresh(spark, root, as_of="2026-08-01")
    assert versions.newest_version(spark, folders.marts) == good
    runs = oplog.run_states(oplog.read_log(spark, folders.ops, "pipeline_runs"))
    assert sorted(r.status for r in runs.collect()) == ["failed", "success"]
    assert "QualityError" in runs.where("status = 'failed'").first().error
    states = oplog.read_log(spark, folders.ops, "task_runs").where("task = 'checks'")
    assert sorted(r.status for r in states.collect()) == ["failed", "success"]


def test_run_log_states(spark):
    at = dt.datetime(2026, 1, 1, 10)
    events = (oplog.run_event(spark, "a", "files", "manual", "running", at)
              .unionByName(oplog.run_event(spark, "a", "files", "manual", "success", at + dt.timedelta(seconds=90)))
              .unionByName(oplog.run_event(spark, "b", "files", "manual", "running", at)))
    closed = events.unionByName(oplog.close_abandoned(events, F.lit(at + dt.timedelta(hours=1)), "b"))
    got = {r.run_id: (r.status, r.duration_s) for r in serving.run_history(oplog.run_states(closed)).collect()}
    assert got == {"a": ("success", 90.0), "b": ("failed", 3600.0)}
    assert serving.last_success(oplog.run_states(closed)).first().run_id == "a"
