"""Newest row per key and newest-release slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tie_columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: first in ``order``, then the smallest of the other columns.

    The remaining columns break ties, so the result depends on values only.
    ``row_number`` with a filter on 1 lets Spark keep one row per key in every
    map task before the shuffle; a key with very many copies costs no more in
    the reduce task than a key with one copy per map task.
    """
    ties = tie_columns if tie_columns is not None else sorted(set(df.columns) - set(keys))
    window = Window.partitionBy(*keys).orderBy(*order, *[F.asc_nulls_last(c) for c in ties])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def latest_release(df: DataFrame, release: str = "release_date") -> Column:
    """The table's own newest release as a scalar subquery."""
    return df.agg(F.max(release)).scalar()


def latest_slice(df: DataFrame, release: str = "release_date", newest: str | None = None) -> DataFrame:
    """Rows of the newest release; where it is known, only its folder is opened."""
    day = latest_release(df, release) if newest is None else F.lit(newest).cast(df.schema[release].dataType)
    return df.where(F.col(release) == day)


def latest_slice_per_feed(df: DataFrame, feed: str = "source_dataset", release: str = "release_date") -> DataFrame:
    """Each feed's own newest release, for feeds that publish on different days."""
    newest = df.groupBy(feed).agg(F.max(release).alias(release))
    return df.join(newest, [feed, release], "left_semi")


def newest_by_group(df: DataFrame, group: str, values: Sequence[str], order: str) -> DataFrame:
    """For each group the newest non-NULL value of each column; equal orders are settled by the larger value.

    Distinct (group, value, order) rows are gathered first, by hash and in the map
    tasks; the ordered pick, which has to sort, sees a few rows per release.
    """
    few = df.select(group, order, *values).distinct()
    return few.groupBy(group).agg(*[value_at_newest(v, F.col(order)).alias(v) for v in values])


def before_latest(df: DataFrame, release: str = "release_date") -> DataFrame:
    return df.where(F.col(release) < latest_release(df, release))


def last_releases(df: DataFrame, n: int = 2, release: str = "release_date") -> DataFrame:
    """Row counts of the ``n`` newest releases."""
    return (df.groupBy(release).agg(F.count(F.lit(1)).alias("row_count"))
              .orderBy(F.desc(release)).limit(n))


def value_at_newest(value: str, order: Column) -> Column:
    """Aggregate: the newest non-NULL value; equal orders are settled by the larger value."""
    v = F.col(value)
    return F.max_by(v, F.when(v.isNotNull(), F.struct(order, v)))
