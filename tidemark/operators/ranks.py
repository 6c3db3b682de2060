"""Exact ranks and quantiles without a window over a whole group.

``percentile`` and ``percent_rank`` gather a group in one task.  With a few
dozen measures a group is a large share of the table, so both are derived here
from one table of distinct values with exact counts below each value:

1. count rows per (group, value); equal values meet in the map tasks
2. lay the distinct values out by range into pieces of similar size, however
   the values are spread, and store them with the number of their piece
3. running totals of the pieces give how many rows lie before each piece, and
   a window inside one piece completes the count

No step sends a group to one task.  The ranges come from a sample, so they are
stored before use: a task that is run again reads the piece it belongs to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder


def value_counts(df: DataFrame, groups: Sequence[str], value: str, counted: dict[str, Column]) -> DataFrame:
    """``(groups, value, counts)``: rows per distinct value, as many counts as are asked for; NULL values are left out.

    Such tables can be kept and merged: the counts of any set of releases, or of
    coarser groups, are sums over theirs.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(*[F.count_if(c).alias(n) for n, c in counted.items()])


def _merged(df: DataFrame, groups: Sequence[str], value: str, rows: str | None) -> DataFrame:
    """Rows per distinct value; a row of ``df`` stands for as many as ``rows`` says."""
    known = df.where(F.col(value).isNotNull()).groupBy(F.struct(*groups).alias("_g"), F.col(value).alias("_v"))
    if rows is None:
        return known.agg(F.count(F.lit(1)).alias("n_eq"))
    return known.agg(F.sum(rows).alias("n_eq")).where("n_eq > 0")


def value_pieces(df: DataFrame, groups: Sequence[str], value: str, pieces: int | None = None, rows: str | None = None) -> DataFrame:
    """Distinct values ``(_g, _v, n_eq, _piece)``, stored; pieces follow each other by group and value.

    Without a number of pieces there are as many as shuffle partitions, or fewer
    where adaptive execution gathers small ones.  The table is written when the
    plan is built, in the shared folder, and stays there for plans that read it.
    """
    counts = _merged(df, groups, value, rows)
    laid = counts.repartitionByRange("_g", "_v") if pieces is None else counts.repartitionByRange(pieces, "_g", "_v")
    placed = laid.withColumn("_piece", F.spark_partition_id())
    path = f"{shared_folder(df.sparkSession)}/tidemark/pieces-{uuid.uuid4().hex}"
    placed.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def ordered_counts(df: DataFrame, groups: Sequence[str], value: str, pieces: int | None = None, rows: str | None = None) -> DataFrame:
    """One row per (group, distinct value) with ``n_eq``, ``n_lt`` and ``n_total`` rows.

    NULL values are left out; ``value`` is numeric.  With ``rows``, a column of stored
    value counts, a row of ``df`` stands for that many.
    """
    placed = value_pieces(df, groups, value, pieces, rows)
    group = Window.partitionBy("_g")
    before = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_g", "_piece").agg(F.sum("n_eq").alias("_rows"))
                     .select("_g", "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                             F.sum("_rows").over(group).alias("n_total")))
    inside = Window.partitionBy("_g", "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_inside", F.coalesce(F.sum("n_eq").over(inside), F.lit(0)))
                  .join(offsets, ["_g", "_piece"])
                  .select(*[F.col("_g")[g].alias(g) for g in groups], F.col("_v").alias(value), "n_eq",
                          (F.col("_before") + F.col("_inside")).alias("n_lt"), "n_total"))


def ordered_counts_few_values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``ordered_counts`` for values from a short list, such as points rounded to one decimal.

    After the first aggregation a group has as many rows as the list has
    values, however many rows it came from, so one window finishes the work.
    """
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(F.struct(*groups).alias("_g"), F.col(value).alias("_v"))
                .agg(F.count(F.lit(1)).alias("n_eq")))
    group = Window.partitionBy("_g")
    before = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*[F.col("_g")[g].alias(g) for g in groups], F.col("_v").alias(value), "n_eq",
                         F.coalesce(F.sum("n_eq").over(before), F.lit(0)).alias("n_lt"),
                         F.sum("n_eq").over(group).alias("n_total"))


def quantiles_from_counts(counts: DataFrame, groups: Sequence[str], value: str,
                          probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles per group from ``ordered_counts``."""
    v = F.col(value).cast("double")

    def place(q: float) -> Column:
        return (F.col("n_total") - 1).cast("double") * F.lit(q)

    ends = {}
    for name, q in probs.items():
        ends[f"_{name}_low"] = F.max(F.when(F.col("n_lt") <= F.floor(place(q)), v))
        ends[f"_{name}_high"] = F.max(F.when(F.col("n_lt") <= F.ceil(place(q)), v))
    grouped = counts.groupBy(*groups).agg(F.max("n_total").alias("n_total"),
                                          *[c.alias(n) for n, c in ends.items()])

    def between(name: str, q: float) -> Column:
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        part = place(q) - F.floor(place(q))
        return F.when(low == high, low).otherwise(low * (F.lit(1.0) - part) + high * part)

    return grouped.select(*groups, "n_total", *[between(n, q).alias(n) for n, q in probs.items()])


def group_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float], rows: str | None = None) -> DataFrame:
    """Exact quantiles per group, also from stored value counts; groups without any value do not appear."""
    return quantiles_from_counts(ordered_counts(df, groups, value, rows=rows), groups, value, probs)


def percent_rank_from_counts() -> Column:
    """Share of the other rows that lie strictly below; 0 for a single row."""
    return F.coalesce(F.try_divide(F.col("n_lt").cast("double"), (F.col("n_total") - 1).cast("double")), F.lit(0.0))


def attach_by_value(df: DataFrame, lookup: DataFrame, groups: Sequence[str], value: str,
                    when: Column, spread_by: Sequence[str]) -> DataFrame:
    """Left join of per-value columns for the rows where ``when`` holds.

    Rows without a match key would all hash alike within their group; they get
    a key part from ``spread_by`` instead and stay spread over the tasks.  A
    value shared by very many rows is split by the adaptive skew join, since
    the lookup side holds one row for it.
    """
    spread = F.when(when, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*spread_by), F.lit(1024)).cast("int"))
    left = df.withColumn("_key", F.when(when, F.col(value))).withColumn("_spread", spread)
    right = lookup.withColumnRenamed(value, "_key").withColumn("_spread", F.lit(0))
    return left.join(right, [*groups, "_key", "_spread"], "left").drop("_key", "_spread")


def descending_rank(df: DataFrame, groups: Sequence[str], value: str, name: str,
                    spread_by: Sequence[str], few_values: bool = False) -> DataFrame:
    """Rank with gaps, largest first, among the rows that have a value; others get NULL."""
    counts = (ordered_counts_few_values if few_values else ordered_counts)(df, groups, value)
    place = (F.col("n_total") - F.col("n_lt") - F.col("n_eq") + 1).cast("int")
    ranks = counts.select(*groups, value, place.alias(name))
    return attach_by_value(df, ranks, groups, value, F.col(value).isNotNull(), spread_by)
