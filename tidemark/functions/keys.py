"""Digests: attribute hash, version key, order-free table fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_MARK = "␀"


def attribute_hash(columns: Sequence[str], null_marks: dict[str, str] | None = None,
                   guard_nulls: bool = True) -> Column:
    """md5 of the ``|``-joined attributes.

    With ``guard_nulls`` every NULL becomes a mark, so NULLs in different
    places give different digests.  Without it NULLs are left out of the join,
    except for columns named in ``null_marks``.
    """
    marks = null_marks or {}
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        if name in marks:
            text = F.coalesce(text, F.lit(marks[name]))
        elif guard_nulls:
            text = F.coalesce(text, F.lit(NULL_MARK))
        parts.append(text)
    return F.md5(F.concat_ws("|", *parts))


def version_key(key: Column, since: Column) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit("|"), since.cast("string")))


def row_digest(columns: Sequence[str]) -> Column:
    """sha256 of a row, columns in name order, NULL told apart from empty text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(NULL_MARK))
             for c in sorted(columns)]
    return F.sha2(F.concat_ws("␟", *parts), 256)


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and content sum per group.

    The sum of the first 60 bits of each row's digest does not depend on row
    order, merges from partial sums, and changes when a row is repeated.
    """
    columns = columns or [c for c in df.columns if c not in by]
    lead = F.conv(F.substring(row_digest(columns), 1, 15), 16, 10).cast("decimal(38,0)")
    return (df.select(*by, lead.alias("_lead"))
              .groupBy(*by)
              .agg(F.count(F.lit(1)).alias("row_count"),
                   F.coalesce(F.sum("_lead"), F.lit(0)).cast("string").alias("content_sum")))
