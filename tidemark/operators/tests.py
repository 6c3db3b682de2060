"""Table tests: each returns the offending rows (an empty result passes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import tiling_faults


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_as: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Like ``duplicate_keys`` on one column; NULLs do not count."""
    return duplicate_keys(df.where(F.col(column).isNotNull()), [column])


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(list(accepted)))


def out_of_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    c = F.col(column)
    return df.where((c < low if low is not None else F.lit(False))
                    | (c > high if high is not None else F.lit(False)))


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is not among the parent's; NULL keys are no fault.

    Parent keys are reduced to distinct values first, so the shuffle carries
    each once per map task.
    """
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str, count_as: str = "n") -> DataFrame:
    """The keys of ``orphan_rows`` with their numbers of rows; the child's rows are counted by key in the map tasks, before they move."""
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_as))
    return orphan_rows(counted, column, parent, parent_column)


def not_in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side that lacks them."""
    a = left.select(F.col(key), F.lit(True).alias("_left"))
    b = right.select(F.col(key), F.lit(True).alias("_right"))
    return (a.join(b, key, "full_outer")
             .where(F.col("_left").isNull() | F.col("_right").isNull())
             .select(key, F.when(F.col("_left").isNull(), "left").otherwise("right").alias("missing_from")))


def wrong_direction(df: DataFrame, group: str, difference: str, category: str = "comparison_category",
                    digits: int = 3) -> DataFrame:
    """Groups whose "better" rows lie on the wrong side of the benchmark on average."""
    from tidemark.functions.numeric import exact_mean
    return (df.where((F.col(category) == "better") & (F.col(group) != "Uncatalogued"))
              .groupBy(group).agg(exact_mean(F.col(difference), digits).alias("avg_diff"))
              .where(F.col("avg_diff") > 0))


def contract_faults(df: DataFrame, contract: T.StructType) -> list[str]:
    """Differences in names, order and types, from the schema alone."""
    faults = []
    if df.columns != contract.names:
        faults.append(f"columns {df.columns} are not {contract.names}")
    actual = {f.name: f.dataType for f in df.schema.fields}
    for field in contract.fields:
        if field.name in actual and actual[field.name] != field.dataType:
            faults.append(f"{field.name} is {actual[field.name].simpleString()}, not {field.dataType.simpleString()}")
    return faults


def null_counts(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``(column, nulls)`` for every column that the contract declares as never NULL, in one pass."""
    names = [f.name for f in contract.fields if not f.nullable and f.name in df.columns]
    counted = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("nulls")) for n in names])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def graded(fault_count: Column, warn_above: int = 0, error_above: int | None = None) -> Column:
    """``pass``, ``warn`` or ``error`` for a number of offending rows."""
    grade = F.when(fault_count > error_above, "error") if error_above is not None else F.when(F.lit(False), "error")
    return grade.when(fault_count > warn_above, "warn").otherwise("pass")


__all__ = ["contract_faults", "duplicate_keys", "graded", "not_in_both", "null_counts", "null_rows", "orphan_counts", "orphan_rows",
           "out_of_range", "repeated_values", "tiling_faults", "unexpected_values", "wrong_direction"]
