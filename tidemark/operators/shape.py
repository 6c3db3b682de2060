"""Pivots, histograms, unions and differences of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_for_item(item: str, wanted: str, value: str) -> Column:
    """Aggregate: the largest value among the rows of one item."""
    return F.max(F.when(F.col(item) == wanted, F.col(value)))


def conformed_union(feeds: dict[str, DataFrame], label: str) -> DataFrame:
    """Feeds under one another by column name, labelled; absent columns become NULL."""
    labelled = [df.withColumn(label, F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def equal_width_histogram(df: DataFrame, groups: Sequence[str], value: str, bins: int = 40) -> DataFrame:
    """Counts in ``bins`` equal ranges between each group's minimum and maximum.

    The maximum belongs to the last bin; a group with a single value fills bin 1.
    """
    present = df.where(F.col(value).isNotNull())
    spans = present.groupBy(*groups).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    share = F.try_divide(F.col(value) - F.col("_low"), F.col("_high") - F.col("_low"))
    bucket = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(bins))).cast("int") + 1, F.lit(bins))
    return (present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
                   .join(spans, list(groups))
                   .groupBy(*groups, bucket.alias("bin"))
                   .agg(F.sum("_n").cast("bigint").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")))


def not_yet_done(available: DataFrame, done: DataFrame, keys: Sequence[str], everything: bool = False) -> DataFrame:
    """Key combinations in ``available`` and not in ``done``; all of them on request."""
    wanted = available.select(*keys).distinct()
    return wanted if everything else wanted.join(done.select(*keys), list(keys), "left_anti")


def newer_than_loaded(df: DataFrame, loaded: DataFrame, release: str = "release_date",
                      floor: str = "1900-01-01") -> DataFrame:
    """Rows of releases past the newest loaded one."""
    mark = loaded.agg(F.coalesce(F.max(release), F.lit(floor).cast("date"))).scalar()
    return df.where(F.col(release) > mark)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))
