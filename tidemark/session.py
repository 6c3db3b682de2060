"""Session settings and the shared folder for tables written on the way."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app_name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the package's settings; keyword settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: For writing a table of wide rows: tasks read little, from files and from shuffles, so that what they sort fits in memory, and
#: rows go to the files of their folders as they come, without a sort by folder; rows beyond that many folders at a time are sorted.
WIDE_ROWS = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def shuffles_for(spark: SparkSession, rows: int, rows_a_task: int) -> dict[str, str]:
    """Settings under which shuffles of ``rows`` wide rows are dealt into parts of at most ``rows_a_task`` on average.

    A session's own number of parts holds where it is larger; it is fixed, so with growing tables its tasks come to spill
    what they sort.  Adaptive execution gathers small parts, but cuts none.
    """
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    now = {key: spark.conf.get(key, None) for key in keys}
    return {key: str(max(int(n), -(-rows // rows_a_task))) for key, n in now.items() if n is not None}


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for as long as the block runs; then the earlier ones hold again."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it; nothing is guessed."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def together(spark: SparkSession, *works: Callable[[], object]) -> list:
    """Submit independent jobs from one thread each, so small ones do not wait for each other."""
    with ThreadPoolExecutor(max_workers=len(works)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
        return [r.result() for r in running]
