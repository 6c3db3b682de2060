"""Tables between steps, kept in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sources import lake

#: A side of a join is broadcast up to this many rows of two longs (16 MB); beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


_WRITTEN: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: later steps start from files that outlive an executor."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_only_last(spark: SparkSession, since: int) -> None:
    """Remove what this process stored from place ``since`` on, but for the table stored last, which needs nothing of it."""
    while len(_WRITTEN) > since + 1:
        lake.remove(spark, _WRITTEN.pop(since))


def written() -> int:
    return len(_WRITTEN)


def keys_of(df: DataFrame, rows: int) -> DataFrame:
    """A narrow key table of ``rows`` counted rows, broadcast if that is few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
