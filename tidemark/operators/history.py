"""Slowly changing history from releases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import version_key


def release_calendar(df: DataFrame, release: str = "release_date") -> DataFrame:
    """Distinct release days with the following one; as many rows as days at most."""
    days = df.select(F.col(release).cast("date").alias("last_release")).distinct()
    return days.withColumn("next_release", F.lead("last_release").over(Window.orderBy("last_release")))


def versions(df: DataFrame, key: str, release: str, state_hash: Column, carry: Sequence[str]) -> DataFrame:
    """One row per run of releases in which the hashed attributes stay equal.

    Input has one row per (key, release), so a key brings at most one row per
    release to its task.  A version ends where the next one starts, or at the
    first release its key no longer appears in.
    """
    by_key = Window.partitionBy(key).orderBy(release)
    marked = (df.withColumn("attr_hash", state_hash)
                .withColumn("_previous", F.lag("attr_hash").over(by_key))
                .withColumn("last_release", F.max(release).over(Window.partitionBy(key))))
    starts = (marked.where(~F.col("attr_hash").eqNullSafe(F.col("_previous")))
                    .withColumn("_next_start", F.lead(release).over(by_key)))
    ends = F.coalesce(F.col("_next_start"), F.col("next_release"))
    return (starts.join(release_calendar(df, release), "last_release", "left")
                  .select(version_key(F.col(key), F.col(release)).alias("version_key"), key, *carry, "attr_hash",
                          F.col(release).alias("valid_from"), ends.alias("valid_to"),
                          ends.isNull().alias("is_current")))


def merged_starts(latest: DataFrame | None, arrived: DataFrame, key: str, release: str, state_hash: Column, carry: Sequence[str]) -> DataFrame:
    """Version starts after new releases arrived: the latest versions before, and what opens after them.

    ``arrived`` holds the rows of releases past all that ``latest`` knows.  ``latest
    (key, carry, attr_hash, valid_from, seen)`` is one row per key with its last
    version and the releases the key was seen in.  The result has ``next_from``, NULL for
    a key's last version, and the key's whole ``seen``.  A key brings one row and one for each
    new release to its task; no older release is read.
    """
    columns = [key, *carry, "attr_hash"]
    fresh = (arrived.withColumn("attr_hash", state_hash)
                    .select(*columns, F.col(release).alias("valid_from"), F.array(release).alias("seen"), F.lit(False).alias("_known")))
    rows = fresh if latest is None else latest.select(*columns, "valid_from", "seen", F.lit(True).alias("_known")).unionByName(fresh)
    by_key = Window.partitionBy(key).orderBy("valid_from")
    whole = Window.partitionBy(key)
    marked = (rows.withColumn("_previous", F.lag("attr_hash").over(by_key))
                  .withColumn("_seen", F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen").over(whole))))))   # one entry per release
    starts = marked.where(F.col("_known") | ~F.col("attr_hash").eqNullSafe(F.col("_previous")))
    return starts.withColumn("next_from", F.lead("valid_from").over(by_key)).select(*columns, "valid_from", "next_from", F.col("_seen").alias("seen"))


def versions_of(starts: DataFrame, calendar: DataFrame, key: str, release: str, carry: Sequence[str]) -> DataFrame:
    """History rows of version starts: closed by the next start, or by the first release the key is absent from."""
    last = starts.withColumn("last_release", F.array_max("seen"))
    ends = F.coalesce(F.col("next_from"), F.col("next_release"))
    return (last.join(calendar, "last_release", "left")
                .select(version_key(F.col(key), F.col("valid_from")).alias("version_key"), key, *carry, "attr_hash",
                        "valid_from", ends.alias("valid_to"), ends.isNull().alias("is_current")))


def value_changes(history: DataFrame, key: str, value: str, carry: Sequence[str], since: str = "valid_from") -> DataFrame:
    """Versions whose value differs from the version before; both must be known."""
    previous = F.lag(value).over(Window.partitionBy(key).orderBy(since))
    return (history.select(key, *carry, since, value, previous.alias("previous_rating"))
                   .where(F.col("previous_rating").isNotNull() & F.col(value).isNotNull()
                          & (F.col(value) != F.col("previous_rating")))
                   .withColumn("rating_change", F.col(value) - F.col("previous_rating")))


def tiling_faults(history: DataFrame, key: str) -> DataFrame:
    """Versions that overlap the next one, leave a gap to it, or end before they start."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    next_from, valid_to = F.col("next_from"), F.col("valid_to")
    return (history.select(key, "valid_from", "valid_to", following.alias("next_from"))
                   .where((next_from.isNotNull() & ~valid_to.eqNullSafe(next_from))
                          | (valid_to.isNotNull() & (valid_to <= F.col("valid_from")))))
