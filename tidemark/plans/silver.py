"""Bronze text to typed, validated, deduplicated silver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators.newest import newest_per_key
from tidemark.operators.routing import REASON, all_kept, key_rules, reject_reasons
from tidemark.session import shared_folder, together
from tidemark.sources import lake
from tidemark.sources.feeds import FEEDS, Feed

Parser = Callable[[Column], Column]


def _same(c: Column) -> Column:
    return c


# Output column -> (feed column, parser); one row per silver column.
Spec = dict[str, tuple[str, Parser]]

HOSPITALS: Spec = {
    "facility_id": ("facility_id", _same),
    "facility_name": ("facility_name", parse.title_case),
    "address": ("address", parse.title_case),
    "city": ("citytown", parse.title_case),
    "state": ("state", _same),
    "zip_code": ("zip_code", parse.to_zip5),
    "county": ("countyparish", parse.title_case),
    "phone": ("telephone_number", _same),
    "hospital_type": ("hospital_type", _same),
    "ownership": ("hospital_ownership", _same),
    "has_emergency_services": ("emergency_services", parse.to_flag),
    "is_birthing_friendly": ("meets_criteria_for_birthing_friendly_designation", parse.to_flag_or_false),
    "overall_rating": ("hospital_overall_rating", parse.to_int),
    "overall_rating_footnote": ("hospital_overall_rating_footnote", _same),
    **{f"{group}_measures_{kind}": (f"count_of_{group}_measures_{kind}", parse.to_int)
       for group in ("mort", "safety", "readm") for kind in ("better", "no_different", "worse")},
}

MEASURES: Spec = {
    "facility_id": ("facility_id", _same),
    "measure_id": ("measure_id", _same),
    "measure_name": ("measure_name", _same),
    "compared_to_national": ("compared_to_national", _same),
    "denominator": ("denominator", parse.to_double),
    "score": ("score", parse.to_double),
    "lower_estimate": ("lower_estimate", parse.to_double),
    "higher_estimate": ("higher_estimate", parse.to_double),
    "number_of_patients": ("number_of_patients", parse.to_int),
    "number_of_patients_returned": ("number_of_patients_returned", parse.to_int),
    "footnote": ("footnote", _same),
    "period_start": ("start_date", parse.to_day),
    "period_end": ("end_date", parse.to_day),
}

SURVEY: Spec = {
    "facility_id": ("facility_id", _same),
    "measure_id": ("hcahps_measure_id", _same),
    "question": ("hcahps_question", _same),
    "answer_description": ("hcahps_answer_description", _same),
    "star_rating": ("patient_survey_star_rating", parse.to_int),
    "answer_percent": ("hcahps_answer_percent", parse.to_int),
    "linear_mean_value": ("hcahps_linear_mean_value", parse.to_int),
    "completed_surveys": ("number_of_completed_surveys", parse.to_int),
    "response_rate_pct": ("survey_response_rate_percent", parse.to_int),
    "period_start": ("start_date", parse.to_day),
    "period_end": ("end_date", parse.to_day),
}


@dataclass(frozen=True)
class FeedPlan:
    feed: Feed
    spec: Spec
    required: tuple[str, str]              # rule name, feed column that must be present
    labels: tuple[tuple[str, str], ...] = ()


PLANS = {
    "hospital_info": FeedPlan(FEEDS["hospital_info"], HOSPITALS, ("missing_name", "facility_name")),
    "complications_deaths": FeedPlan(FEEDS["complications_deaths"], MEASURES, ("missing_measure_id", "measure_id"),
                                     (("source_dataset", "complications_deaths"),)),
    "unplanned_visits": FeedPlan(FEEDS["unplanned_visits"], MEASURES, ("missing_measure_id", "measure_id"),
                                 (("source_dataset", "unplanned_visits"),)),
    "hcahps": FeedPlan(FEEDS["hcahps"], SURVEY, ("missing_measure_id", "hcahps_measure_id")),
}


@dataclass(frozen=True)
class SilverParts:
    good: DataFrame     # typed rows that keep every rule, duplicates still in
    bad: DataFrame      # rejected rows, as cleaned text, with reasons
    rows: DataFrame     # newest good row per key
    by_release: DataFrame   # rows_in, quarantined, unparseable per release

    @property
    def stats(self) -> DataFrame:
        """The counts of all releases in one row."""
        return self.by_release.agg(*[F.sum(n).alias(n) for n in COUNTS])


COUNTS = ["rows_in", "quarantined", "unparseable_numerics"]


def judged(bronze: DataFrame, dataset: str) -> DataFrame:
    """Every bronze row once: its silver columns, whether it is accepted, and of a rejected row the cleaned text and reasons.

    ``_lost`` marks an accepted row with a score that is there and gave no number.
    """
    plan = PLANS[dataset]
    needed = [source for source, _ in plan.spec.values()]
    cleaned = parse.add_missing_text(parse.clean_text_columns(bronze), needed)
    rule, column = plan.required
    rules = key_rules() | {rule: F.col(column).isNotNull()}
    accepted = all_kept(rules)
    rejected = F.when(~accepted, F.struct(*[F.col(c) for c in cleaned.columns if c not in ("release_date", "_ingested_at")]))
    lost = F.col("score").isNotNull() & parse.to_double(F.col("score")).isNull() if "score" in plan.spec else F.lit(False)
    return cleaned.select(
        *[parser(F.col(source)).alias(name) for name, (source, parser) in plan.spec.items()],
        *[F.lit(value).alias(name) for name, value in plan.labels],
        "release_date", "_ingested_at", accepted.alias("_accepted"), (accepted & lost).alias("_lost"), rejected.alias("_text"),
        F.when(~accepted, reject_reasons(rules)).alias(REASON))


def parts_of(rows: DataFrame, dataset: str) -> SilverParts:
    """What becomes of judged rows."""
    plan = PLANS[dataset]
    labelled = [name for name, _ in plan.labels]
    good = rows.where("_accepted").select(*plan.spec, *labelled, "release_date", "_ingested_at")
    bad = rows.where("not _accepted").select("_text.*", "release_date", "_ingested_at", REASON)
    newest = (newest_per_key(good.drop(*labelled), plan.feed.key, [F.desc_nulls_last("_ingested_at")])     # constants need not move
              .withColumns({name: F.lit(value) for name, value in plan.labels}).select(*good.columns))
    counts = rows.groupBy("release_date").agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(~F.col("_accepted")).alias("quarantined"), F.count_if("_lost").alias("unparseable_numerics"))
    return SilverParts(good, bad, newest, counts)


def silver_parts(bronze: DataFrame, dataset: str) -> SilverParts:
    return parts_of(judged(bronze, dataset), dataset)


def silver_hospitals(bronze: DataFrame) -> DataFrame:
    return silver_parts(bronze, "hospital_info").rows


def silver_measures(feeds: dict[str, DataFrame]) -> DataFrame:
    """The measure feeds in one table; each is deduplicated on its own."""
    parts = [silver_parts(bronze, name).rows for name, bronze in feeds.items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def silver_survey(bronze: DataFrame) -> DataFrame:
    return silver_parts(bronze, "hcahps").rows


# --- the job ---------------------------------------------------------------------------
DONE = ("dataset string, release_date string, content_sum string, rows_in bigint, rows_out bigint, quarantined bigint, "
        "duplicates_removed bigint, unparseable_numerics bigint, done_at timestamp")


def done_log(silver_folder: str) -> str:
    """Where a silver folder notes the releases that were processed, wholly rejected ones too."""
    return f"{silver_folder}/releases_done"


def releases_done(spark: SparkSession, silver_folder: str) -> DataFrame:
    """The newest entry per (dataset, release); one row each, whatever the size of the releases."""
    log = lake.read_table_or_none(spark, done_log(silver_folder))
    if log is None:
        return spark.createDataFrame([], DONE)
    names = [c.split()[0] for c in DONE.split(", ")]
    newest = F.max_by(F.struct(*names), F.struct("done_at", "content_sum", "rows_in", "rows_out"))
    return log.groupBy("dataset", "release_date").agg(newest.alias("_r")).select("_r.*")


def pending_releases(spark: SparkSession, bronze_folder: str, silver_folder: str, dataset: str, full_refresh: bool = False,
                     landed: DataFrame | None = None) -> list[tuple[str, str | None]]:
    """``(release, content sum)`` of what silver has not seen in this form, one per release.

    ``landed (dataset, release_date, content_sum)`` is the current manifest: a release
    whose sum differs from the one that was processed is pending again.  Without
    it, the releases are the names of the bronze folders and their sums unknown.
    """
    if landed is None:
        there = {f["release_date"]: None for f in lake.partition_folders(spark, f"{bronze_folder}/{dataset}")}
    else:
        there = {r.release_date: r.content_sum for r in landed.where(F.col("dataset") == dataset).select("release_date", "content_sum").collect()}
    done = {r.release_date: r.content_sum for r in releases_done(spark, silver_folder).where(F.col("dataset") == dataset).collect()}
    return sorted((release, total) for release, total in there.items()
                  if full_refresh or release not in done or (total is not None and done[release] != total))


def process_releases(spark: SparkSession, bronze_folder: str, silver_folder: str, quarantine_folder: str, dataset: str,
                     releases: Sequence[tuple[str, str | None]]) -> list[dict]:
    """Rebuild some releases of a feed from all of their bronze rows; one entry of counts each.

    Bronze is read once: the judged rows are stored by whether they are accepted,
    and counts, rejects and newest rows are taken from there.
    """
    feed, names = FEEDS[dataset], [r for r, _ in releases]
    table_path = f"{silver_folder}/{feed.table}"
    stage = f"{shared_folder(spark)}/tidemark/judged-{uuid.uuid4().hex}"
    rows = judged(lake.read_releases(spark, f"{bronze_folder}/{dataset}", names), dataset)
    rows.write.option("compression", "zstd").partitionBy("_accepted").parquet(stage)
    parts = parts_of(spark.read.schema(rows.schema).parquet(stage), dataset)
    counted, _, _ = together(
        spark, parts.by_release.collect,  # one row per release
        lambda: lake.write_partitions(parts.rows, table_path, feed.partitions),
        lambda: lake.replace_quarantine(parts.bad, f"{quarantine_folder}/{dataset}", names))
    counts = {r["release_date"]: r for r in counted}
    for release in names:
        if release not in counts or counts[release]["rows_in"] == counts[release]["quarantined"]:
            # nothing was written over what an earlier run left
            where = {"source_dataset": dataset, "release_date": release}
            lake.empty_partition(parts.rows, table_path, {p: where[p] for p in feed.partitions})
    written = lake.read_table(spark, table_path).where(F.col("release_date").isin(names))
    if "source_dataset" in feed.partitions:
        written = written.where(F.col("source_dataset") == dataset)
    out = dict(written.groupBy("release_date").count().collect())
    moment = datetime.now(UTC).replace(tzinfo=None)
    entries = []
    for release, total in releases:
        n = counts[release].asDict() if release in counts else dict.fromkeys(COUNTS, 0)
        kept = out.get(release, 0)
        entries.append({"dataset": dataset, "release_date": release, "content_sum": total, "rows_in": n["rows_in"], "rows_out": kept,
                        "quarantined": n["quarantined"], "duplicates_removed": n["rows_in"] - n["quarantined"] - kept,
                        "unparseable_numerics": n["unparseable_numerics"], "done_at": moment})
    note = spark.createDataFrame(entries, DONE).drop("dataset").coalesce(1)
    note.write.mode("append").parquet(f"{done_log(silver_folder)}/dataset={dataset}")     # a folder each: feeds are noted side by side
    lake.remove(spark, stage)
    return entries


def refresh_feed(spark: SparkSession, bronze_folder: str, silver_folder: str, quarantine_folder: str,
                 name: str, full_refresh: bool = False, landed: DataFrame | None = None) -> dict:
    """Bring one feed's pending releases to silver; returns its counts."""
    pending = pending_releases(spark, bronze_folder, silver_folder, name, full_refresh, landed)
    entries = process_releases(spark, bronze_folder, silver_folder, quarantine_folder, name, pending) if pending else []
    return {"table": f"{FEEDS[name].table}<-{name}", "releases": [r for r, _ in pending],
            **{n: sum(e[n] for e in entries) for n in ("rows_in", "rows_out", "quarantined", "duplicates_removed", "unparseable_numerics")}}


def refresh_silver(spark: SparkSession, bronze_folder: str, silver_folder: str, quarantine_folder: str,
                   full_refresh: bool = False, datasets: list[str] | None = None, landed: DataFrame | None = None) -> list[dict]:
    """Process pending releases of every feed; one dictionary of counts per feed.

    Tables are refreshed side by side; feeds that share a table follow one another.
    """
    by_table: dict[str, list[str]] = {}
    for name in datasets or list(FEEDS):
        by_table.setdefault(FEEDS[name].table, []).append(name)

    def refresh_table(names: list[str]) -> list[dict]:
        return [refresh_feed(spark, bronze_folder, silver_folder, quarantine_folder, n, full_refresh, landed) for n in names]

    done = together(spark, *[lambda names=names: refresh_table(names) for names in by_table.values()])
    return [entry for entries in done for entry in entries]
