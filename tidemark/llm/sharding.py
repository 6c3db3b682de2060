"""Shards by jump consistent hashing, with a gapless place in each shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

_MULTIPLIER = np.uint64(2862933555777941757)          # fixed value of the published function


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Bucket of each 64-bit key; going to ``shards + 1`` moves a key only into the new bucket."""
    state, at, following = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys)) if shards > 0 else np.empty(0, np.int64)
    while len(moving):
        at[moving] = following[moving]
        state[moving] = state[moving] * _MULTIPLIER + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        following[moving] = ((at[moving] + 1) * (2.0**31 / draw)).astype(np.int64)
        moving = moving[following[moving] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a key column of any type."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def place(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``.

    The id and the number of shards alone decide (law ``key``), so rows that share
    an id share a shard, and ``grown_shard``, the shard among one more, is either
    ``shard`` or the new one.  A null id is a key like any other.  Null text counts
    as no bytes.  ``slot`` numbers a shard's rows from 0 without gaps.

    Slots come from prefix sums over (shard, part), where a part is what one task
    wrote; no group is larger than one task's rows, whatever the ids are.  Only
    the narrow columns are written and shuffled.  Other columns are ignored.
    """
    text = F.col(text_col)
    narrow = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col(id_col), shards).alias("shard"), shard_of(F.col(id_col), shards + 1).alias("grown_shard"),
        F.spark_partition_id().alias("part")), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(narrow.groupBy("shard", "part").count()
                   .withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "bases")
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    return (narrow.join(bases, ["shard", "part"])
            .withColumn("slot", (F.col("base") + F.row_number().over(inside) - 1).cast("long"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
