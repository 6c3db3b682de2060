"""Partitioned Parquet folders: scans, writes and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 5_000_000


def read_table(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """A partitioned table.

    ``merge`` gathers the columns of all files, which reads every footer; it is
    for tables whose columns may grow.  Release folders are discovered as dates
    by Spark, and tables hold releases as text, so the column is cast back.
    """
    df = spark.read.option("mergeSchema", merge).parquet(path)
    return df.withColumn("release_date", F.col("release_date").cast("string")) if "release_date" in df.columns else df


def read_table_or_none(spark: SparkSession, path: str, merge: bool = False) -> DataFrame | None:
    try:
        return read_table(spark, path, merge)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_releases(spark: SparkSession, path: str, releases: Sequence[str]) -> DataFrame:
    """Bronze rows of the given releases, with the columns of their files; no other folder is opened."""
    folders = [f"{path}/release_date={r}" for r in releases]
    df = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)
    return (df.withColumn("release_date", F.col("release_date").cast("string"))
              .withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp")))


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` holds.

    The rebalance hint gathers small partitions and splits large ones by
    measured size, so a release with most of the rows is still written by many
    tasks.
    """
    (df.hint("rebalance", *partitions)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", ROWS_PER_FILE)
       .option("compression", "zstd")
       .partitionBy(*partitions).parquet(path))


def empty_partition(like: DataFrame, path: str, partition: Mapping[str, str]) -> None:
    """Replace one partition by a file without rows (a partitioned write leaves it as it is)."""
    place = "/".join(f"{name}={value}" for name, value in partition.items())
    like.drop(*partition).where(F.lit(False)).write.mode("overwrite").parquet(f"{path}/{place}")


def replace_quarantine(bad: DataFrame, path: str, releases: Sequence[str]) -> None:
    """Rejected rows of the given releases, replacing what an earlier run rejected.

    A release without rejects gets one marker row, so that a rerun that comes
    out clean also replaces the old rejects; ``read_quarantine`` leaves markers
    out.
    """
    spark = bad.sparkSession
    names = [f.name for f in bad.schema.fields]
    marker = (spark.range(1)
              .select(F.explode(F.array(*[F.lit(r) for r in releases])).alias("release_date"))
              .select(*[F.col("release_date") if n == "release_date" else F.lit(None).cast(bad.schema[n].dataType).alias(n)
                        for n in names], F.lit(True).alias("_marker")))
    write_partitions(bad.withColumn("_marker", F.lit(False)).unionByName(marker), path, ["release_date"])


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, merge=True).where(~F.col("_marker")).drop("_marker")


def partition_folders(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """Partition values by folder names alone, such as ``{"release_date": "2026-07-22"}``; no file is opened.

    A folder counts when it holds a data file.  A path that is absent has none.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop.Path(path)):
        return []
    found, open_ = [], [(path, {})]
    while open_:
        folder, values = open_.pop()
        entries = [(e.getPath().getName(), e.isDirectory()) for e in fs.listStatus(hadoop.Path(folder))]
        if values and any(not is_folder and name[0] not in "._" for name, is_folder in entries):
            found.append(values)
        open_ += [(f"{folder}/{name}", values | {key: value}) for name, is_folder in entries if is_folder
                  for key, eq, value in [name.partition("=")] if eq]
    return sorted(found, key=lambda v: sorted(v.items()))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of one's own, such as a table between two steps."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop.Path(path), True)
