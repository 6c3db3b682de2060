"""The whole refresh: silver, checks, gold, model tests, snapshot and logs in one folder.

What a refresh works on is decided by origins: a manifest entry names the
content of a landed release, silver notes which content it processed, and
every published part notes what it was made from.  Only what differs is made
anew; everything else is pointed to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import fingerprint
from tidemark.plans import gate, gold, model_tests, oplog, silver
from tidemark.session import together
from tidemark.sources import lake, landing, versions
from tidemark.sources.feeds import FEEDS, measure_catalog, state_regions

#: Goes into the origin of every part: a change of what the models mean makes all parts stale.
MODELS = "2"
#: A run that is still open after this time is taken for dead.
ABANDONED_AFTER = timedelta(hours=24)


@dataclass(frozen=True)
class Lake:
    """Folders of one pipeline under a common root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def marts(self) -> str:
        return f"{self.root}/gold/marts"

    @property
    def ops(self) -> str:
        return f"{self.root}/ops"

    @property
    def published_ops(self) -> str:
        return f"{self.root}/gold/ops"


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def new_run_id() -> str:
    """Ids carry no order; times are columns of the logs."""
    return f"refresh-{uuid.uuid4()}"


def land(spark: SparkSession, folders: Lake, dataset: str, release: str, rows: DataFrame, run_id: str,
         source: str, force: bool = False, corrections: bool = True) -> bool:
    """Land one release of a feed unless the manifest already has it; tells whether it did.

    A release that is there with other content is a correction and replaces it.
    Without ``corrections`` a release that is there at all is left alone, and its
    rows are not read.
    """
    manifest = lake.read_table_or_none(spark, f"{folders.ops}/ingest_manifest")
    if manifest is not None and not force:
        known = landing.current_manifest(manifest).where((F.col("dataset") == dataset) & (F.col("release_date") == release)).first()
        if known is not None:
            text = rows.select(*[F.col(c).cast("string") for c in sorted(rows.columns)])
            if not corrections or fingerprint(text).first()["content_sum"] == known["content_sum"]:
                return False
    moment = now().isoformat()
    path = landing.land_release(landing.to_bronze(rows, run_id, release, source, moment), folders.bronze, dataset, release)
    note_landed(spark, folders, dataset, [release], sorted(rows.columns), run_id, moment)
    return True


def note_landed(spark: SparkSession, folders: Lake, dataset: str, releases: list[str], columns: list[str], run_id: str, moment: str) -> None:
    """Count and sum up releases as they lie in bronze, and note them in the manifest."""
    path = f"{folders.bronze}/{dataset}"
    delivered = lake.read_releases(spark, path, releases).select("release_date", *columns)
    oplog.append(landing.manifest_entry(delivered, run_id, dataset, path, moment), folders.ops, "ingest_manifest")


def silver_tables(spark: SparkSession, folders: Lake) -> dict[str, DataFrame]:
    return {name: lake.read_table(spark, f"{folders.silver}/{name}") for name in ("hospitals", "measure_scores", "hcahps")}


@dataclass(frozen=True)
class Origins:
    """Which content each silver release was made from, and which releases hold rows: from the log, not from rows."""

    done: tuple[tuple[str, str, int, str], ...]         # dataset, release, rows, moment

    @classmethod
    def read(cls, spark: SparkSession, folders: Lake) -> Origins:
        rows = silver.releases_done(spark, folders.silver).collect()      # one per dataset and release
        return cls(tuple(sorted((r.dataset, r.release_date, r.rows_out, r.done_at.isoformat()) for r in rows)))

    def of(self, *datasets: str) -> dict[str, str]:
        """For each release one text that changes when any of the feeds was processed again."""
        found: dict[str, str] = {}
        for dataset, release, _, moment in self.done:
            if dataset in datasets:
                found[release] = found.get(release, MODELS) + f" {dataset}@{moment}"
        return found

    def releases(self, *datasets: str) -> list[str]:
        return sorted({release for dataset, release, rows, _ in self.done if dataset in datasets and rows})

    def newest(self, *datasets: str) -> str | None:
        return max(self.releases(*datasets), default=None)


MEASURE_FEEDS = tuple(f.name for f in FEEDS.values() if f.table == "measure_scores")


def build_gold(spark: SparkSession, folders: Lake, version: str, full_refresh: bool = False, blocking: bool = True) -> versions.Version:
    """Write what is stale of all marts under ``version``, test them and publish; returns the published entry.

    Every mart reads the stored form of the marts it builds on.  When a model test
    ends with an error nothing is published, unless tests are not ``blocking``.
    """
    tables, origins = silver_tables(spark, folders), Origins.read(spark, folders)
    regions, catalog = state_regions(spark), measure_catalog(spark)
    hospitals = gold.stg_hospitals(tables["hospitals"])
    scores = gold.stg_measure_scores(tables["measure_scores"])
    survey_rows = gold.stg_survey(tables["hcahps"])
    out = versions.Snapshot(spark, folders.marts, version)

    def by_release(table: str, feeds: tuple[str, ...], build: Callable[[list[str]], DataFrame], cluster: str | None = None) -> DataFrame:
        """Parts of releases whose feeds were processed again are built anew, the others kept."""
        wanted = origins.of(*feeds)
        stale = sorted(wanted) if full_refresh else out.stale(table, wanted)
        if table in out.before.schemas:
            out.keep(table, sorted(set(wanted) - set(stale)))
        if stale or table not in out.before.schemas:
            out.put(table, build(stale), release="release_date", origins={r: wanted[r] for r in stale}, cluster=cluster)
        return out.table(table)

    def some(rows: DataFrame, releases: list[str]) -> DataFrame:
        return rows.where(F.col("release_date").isin([F.lit(r).cast("date") for r in releases]))    # literals: only these folders are opened

    def facts():
        by_release("score_counts", MEASURE_FEEDS, lambda stale: gold.score_counts(some(scores, stale)))
        return by_release("fct_measure_scores", MEASURE_FEEDS, lambda stale: gold.with_load_time(gold.benchmark_scores(
            some(scores, stale), catalog, out.parts("score_counts", stale)).select(*gold.FACT_COLUMNS)), cluster="facility_id")

    def history():
        stored = build_history(out, hospitals, origins, regions, full_refresh)
        out.put("mart_rating_changes", gold.rating_changes(stored))
        return stored

    def experience():
        return by_release("fct_patient_experience", ("hcahps",), lambda stale: gold.survey_pivot(some(survey_rows, stale)), cluster="facility_id")

    newest = origins.newest("hospital_info")
    fact_table, dim, measures, survey, versions_ = together(
        spark, facts, lambda: out.put("dim_hospital", gold.dim_hospital(hospitals, regions, newest)),
        lambda: out.put("dim_measure", gold.dim_measure(scores, catalog)), experience, history)

    def last(table: str, whole: DataFrame) -> DataFrame:
        return out.parts(table, sorted(p.name for p in out.now.of(table).values() if p.rows)[-1:]) if out.now.rows[table] else whole

    def scorecard():
        known = gold.previous_ratings(versions_, newest) if newest else None
        stored = out.put("mart_hospital_scorecard", gold.hospital_scorecard(
            dim, fact_table, survey, hospitals, latest_facts=last("fct_measure_scores", fact_table),
            latest_survey=last("fct_patient_experience", survey), previous=known))
        out.put("mart_state_summary", gold.state_summary(stored))

    def benchmarks():
        numbers = by_release("benchmark_numbers", MEASURE_FEEDS, lambda stale: gold.benchmark_numbers(
            out.parts("fct_measure_scores", stale), out.parts("score_counts", stale)))
        out.put("mart_measure_benchmarks", gold.named_benchmarks(numbers, measures))

    together(spark, scorecard, benchmarks)
    models = {name: out.table(name) for name in out.now.schemas} | {
        "stg_hospitals": hospitals, "stg_measure_scores": scores, "stg_survey": survey_rows,
        "state_regions": regions, "measure_catalog": catalog}
    results = model_tests.run_model_tests(spark, models)
    oplog.append(results.select(F.lit(version).alias("run_id"), F.lit(now()).alias("checked_at"), "*"), folders.ops, "model_tests")
    if blocking:
        model_tests.enforce(results)
    return out.commit()


def build_history(out: versions.Snapshot, hospitals: DataFrame, origins: Origins, regions: DataFrame, full_refresh: bool = False) -> DataFrame:
    """``dim_hospital_history`` after what was processed since the version before.

    Releases past all known ones are merged into the latest versions; releases that
    changed, went or came late reopen the facilities they touch.  Versions closed
    before are pointed to, unless a reopened facility has one among them.
    """
    wanted = origins.of("hospital_info")
    known = out.before.of("history_latest")
    seen = json.loads(known["all"].origin) if known else {}
    new = sorted(set(wanted) - set(seen))
    moved = sorted(r for r in seen if seen[r] != wanted.get(r)) + [r for r in new if seen and r < max(seen)]
    calendar = hospitals.sparkSession.createDataFrame([(r,) for r in origins.releases("hospital_info")], "r string").select(
        F.col("r").cast("date").alias("release_date"))
    if known:
        before = gold.History(out.keep("history_closed"), out.keep("history_latest"))
    if full_refresh or not known:
        after, closed_label = gold.merge_releases(None, hospitals), "all"
    elif moved:
        late = [r for r in new if r > max(seen)]
        # what is past all known releases counts as touched too: one pass serves both
        after, closed_label = gold.reopen_releases(before, hospitals, [*moved, *late]), "all"
    elif new:
        fresh = hospitals.where(F.col("release_date").isin([F.lit(r).cast("date") for r in new]))
        after, closed_label = gold.merge_releases(before, fresh), f"until-{new[-1]}"
    else:
        return out.keep("dim_hospital_history")
    if closed_label == "all":
        out.drop("history_closed")
    origin = {"all": json.dumps(wanted)}
    closed, latest = together(out.spark, lambda: out.put("history_closed", after.closed, label=closed_label),
                              lambda: out.put("history_latest", after.latest, origins=origin))
    return out.put("dim_hospital_history", gold.dim_hospital_history(gold.History(closed, latest).versions(calendar), regions))


OPS_TABLES = ("ingest_manifest", "pipeline_runs", "task_runs", "dq_results", "model_tests")


def publish_ops(spark: SparkSession, folders: Lake, version: str) -> versions.Version:
    """The logs as one published version: runs and landed releases in their current state, the others as they are."""
    reduced = {"ingest_manifest": landing.current_manifest, "pipeline_runs": oplog.run_states}
    out = versions.Snapshot(spark, folders.published_ops, version)

    def put(name: str) -> None:
        log = oplog.read_log_or_none(spark, folders.ops, name)
        if log is not None:
            out.put(name, reduced.get(name, lambda df: df)(log).coalesce(1))     # logs are small: a row per run, step, release or check

    together(spark, *[lambda name=name: put(name) for name in OPS_TABLES])
    return out.commit()


def close_dead_runs(spark: SparkSession, folders: Lake) -> None:
    """Note as failed what has been running for too long to be alive."""
    runs = oplog.read_log_or_none(spark, folders.ops, "pipeline_runs")
    if runs is not None:
        oplog.append(oplog.close_abandoned(runs, F.lit(now()), before=now() - ABANDONED_AFTER), folders.ops, "pipeline_runs")


def refresh(spark: SparkSession, root: str, as_of: str, source: str = "files", trigger: str = "manual",
            full_refresh: bool = False, blocking: bool = True) -> str:
    """Bring silver, gold and the snapshot up to date with the landed bronze.

    Runs that were left open long ago are closed first.  Failed checks and model
    tests stop the run; if they are not ``blocking`` they are only noted.  The logs
    are published after every run, also after one that failed.
    """
    folders, run_id = Lake(root), new_run_id()
    close_dead_runs(spark, folders)
    oplog.append(oplog.run_event(spark, run_id, source, trigger, "running", now()), folders.ops, "pipeline_runs")

    def step(task: str, work: Callable[[], tuple[int | None, dict]]) -> None:
        started, status, rows, details = now(), "success", None, {}
        try:
            rows, details = work()
        except Exception as error:
            status, details = "failed", {"error": repr(error)}
            raise
        finally:
            event = oplog.task_event(spark, run_id, task, started, now(), status, rows, json.dumps(details))
            oplog.append(event, folders.ops, "task_runs")

    state: dict = {}

    def clean():
        manifest = lake.read_table_or_none(spark, f"{folders.ops}/ingest_manifest")
        landed = None if manifest is None else landing.current_manifest(manifest)
        state["stats"] = silver.refresh_silver(spark, folders.bronze, folders.silver, folders.quarantine, full_refresh, landed=landed)
        return sum(s["rows_out"] for s in state["stats"]), {"tables": state["stats"]}

    def checks():
        results = gate.run_checks(silver_tables(spark, folders), as_of, state["stats"], refreshed_ledger(spark, folders, state["stats"]))
        log = f"{folders.ops}/dq_results"
        oplog.append(oplog.check_events(results, run_id, F.lit(now())), folders.ops, "dq_results")
        stored = spark.read.parquet(log).where(F.col("run_id") == run_id)
        if blocking:
            gate.enforce(stored)
        return stored.count(), {}

    def publish():
        entry = build_gold(spark, folders, run_id, full_refresh, blocking)
        return sum(entry.rows.values()), {"published": entry.rows}

    try:
        step("silver", clean)
        step("checks", checks)
        step("gold_and_publish", publish)
    except Exception as error:
        failed = oplog.run_event(spark, run_id, source, trigger, "failed", now(), repr(error))
        oplog.append(failed, folders.ops, "pipeline_runs")
        publish_ops(spark, folders, run_id)
        raise
    oplog.append(oplog.run_event(spark, run_id, source, trigger, "success", now()), folders.ops, "pipeline_runs")
    publish_ops(spark, folders, run_id)
    return run_id


def refreshed_ledger(spark: SparkSession, folders: Lake, stats: list[dict]) -> DataFrame:
    """The check ledger after the releases that were just written are counted again.

    All releases are counted when there is no ledger yet, or when some number of it could not be counted.
    """
    log = oplog.read_log_or_none(spark, folders.ops, "check_ledger")
    written: dict[str, set[str]] = {}
    for entry in stats:
        written.setdefault(entry["table"].split("<-")[0], set()).update(entry["releases"])
    whole = log is None or not gate.current_ledger(log).where("error is not null").isEmpty()
    counted = gate.measure(spark, silver_tables(spark, folders), None if whole else {t: sorted(r) for t, r in written.items()})
    oplog.append(counted, folders.ops, "check_ledger")
    return gate.current_ledger(oplog.read_log(spark, folders.ops, "check_ledger"))
