"""From delivered pages to bronze: every source column a string, plus audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import fingerprint

AUDIT_COLUMNS = ["_run_id", "_source", "_ingested_at", "_release_date"]


class EmptyFeedError(ValueError):
    """A source delivered no rows."""


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages ``{offset, count, results:[{...}]}``, one JSON document per file.

    Record fields are read as text, and their names are the union over all
    records.
    """
    return spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)


def wanted_pages(pages: DataFrame, by: list[str], rows: Column) -> DataFrame:
    """Pages before the first empty one; what follows an empty page is ignored.

    Only (offset, row count) is grouped; page bodies move at most once, in the
    join, and not at all where Spark broadcasts the stops.
    """
    offset = F.col("offset").cast("bigint")
    if not by:
        stop = pages.agg(F.min(F.when(rows == 0, offset)).alias("s")).scalar()
        return pages.where(offset < F.coalesce(stop, F.lit(2**63 - 1)))
    stops = pages.groupBy(*by).agg(F.min(F.when(rows == 0, offset)).alias("_stop"))
    return (pages.join(stops, by)
                 .where(offset < F.coalesce(F.col("_stop"), F.lit(2**63 - 1)))
                 .drop("_stop"))


def land_pages(pages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Records of all wanted pages, one row each."""
    by = by or []
    kept = wanted_pages(pages, by, F.size("results"))
    return kept.select(*by, F.explode("results").alias("_r")).select(*by, "_r.*")


def page_totals(pages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows landed against rows announced by the source."""
    by = by or []
    kept = wanted_pages(pages, by, F.size("results"))
    return kept.groupBy(*by).agg(
        F.sum(F.size("results")).cast("bigint").alias("rows_landed"),
        F.max(F.col("count").cast("bigint")).alias("rows_announced"),
    ).withColumn("is_complete", F.col("rows_landed") == F.col("rows_announced"))


def release_of(modified: Column, today: Column | None = None) -> Column:
    """Release day of a feed: first ten characters of ``modified``, else today."""
    today = today if today is not None else F.current_date()
    day = F.substring(modified, 1, 10)
    return F.coalesce(F.when(day != "", day), today.cast("string"))


def new_releases(available: DataFrame, manifest: DataFrame, force: bool = False,
                 notice_corrections: bool = False) -> DataFrame:
    """(dataset, release_date) not landed yet; all of them with ``force``.

    With ``notice_corrections`` a landed release whose content sum differs from
    the delivered one counts as new too.
    """
    if force:
        return available
    keys = ["dataset", "release_date"] + (["content_sum"] if notice_corrections else [])
    return available.join(manifest.select(*keys).distinct(), keys, "left_anti")


def to_bronze(rows: DataFrame, run_id: str, release: str | Column, source: str, ingested_at: str | Column) -> DataFrame:
    """All columns as strings in name order, then the audit columns."""
    release = F.lit(release) if isinstance(release, str) else release
    moment = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return rows.select(
        *[F.col(c).cast("string") for c in sorted(rows.columns)],
        F.lit(run_id).alias("_run_id"), F.lit(source).alias("_source"),
        moment.cast("string").alias("_ingested_at"), release.cast("string").alias("_release_date"))


def refuse_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyFeedError(f"{what}: the source delivered no rows")
    return df


def land_release(bronze: DataFrame, folder: str, dataset: str, release: str, rows_per_file: int = 5_000_000) -> str:
    """Write one release as a partition of the feed's bronze folder, replacing it whole."""
    path = f"{folder}/{dataset}"
    refuse_empty(bronze, f"{dataset} {release}")
    (bronze.withColumn("release_date", F.lit(release))
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .option("maxRecordsPerFile", rows_per_file)
           .option("compression", "zstd")
           .partitionBy("release_date").parquet(path))
    return path


MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("content_sum", T.StringType()),
    T.StructField("bronze_path", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])


def manifest_entry(landed: DataFrame, run_id: str, dataset: str, path: str, ingested_at: str) -> DataFrame:
    """One manifest row per release of a landed bronze table (audit columns left out)."""
    source_columns = [c for c in landed.columns if c not in AUDIT_COLUMNS and c != "release_date"]
    sums = fingerprint(landed, ["release_date"], source_columns)
    return sums.select(F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset"),
                       F.col("release_date").cast("string").alias("release_date"), F.col("row_count").alias("rows"),
                       "content_sum", F.lit(path).alias("bronze_path"),
                       F.lit(ingested_at).cast("timestamp").alias("ingested_at"))


def current_manifest(log: DataFrame) -> DataFrame:
    """Newest entry per (dataset, release_date) of an append-only manifest."""
    rest = [c for c in log.columns if c not in ("dataset", "release_date", "ingested_at")]
    newest = F.max_by(F.struct(*log.columns), F.struct("ingested_at", *rest))
    return log.groupBy("dataset", "release_date").agg(newest.alias("_r")).select("_r.*")
