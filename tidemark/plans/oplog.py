"""Run, task, manifest and check logs: appended events, reduced to current state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.lake import read_table_or_none

RUN_EVENTS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("error", T.StringType()),
])

TASK_RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("details", T.StringType()),
])

# The part of the silver task's details that reports cleaning counts per table.
DETAILS = ("struct<tables: array<struct<table: string, rows_in: bigint, rows_out: bigint, quarantined: bigint, "
           "duplicates_removed: bigint, unparseable_numerics: bigint>>>")


def append(events: DataFrame, folder: str, log: str) -> None:
    events.coalesce(1).write.mode("append").parquet(f"{folder}/{log}")


def read_log(spark: SparkSession, folder: str, log: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(f"{folder}/{log}")


def read_log_or_none(spark: SparkSession, folder: str, log: str) -> DataFrame | None:
    return read_table_or_none(spark, f"{folder}/{log}", merge=True)


def run_event(spark: SparkSession, run_id: str, source: str, trigger: str, status: str, at: datetime,
              error: str | None = None) -> DataFrame:
    return spark.createDataFrame([(run_id, source, trigger, status, at, error)], RUN_EVENTS)


def task_event(spark: SparkSession, run_id: str, task: str, started: datetime, finished: datetime, status: str,
               rows_out: int | None, details: str) -> DataFrame:
    seconds = round((finished - started).total_seconds(), 3)
    return spark.createDataFrame([(run_id, task, started, finished, seconds, status, rows_out, details)], TASK_RUNS)


def is_final(status: Column) -> Column:
    return status != "running"


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: when it started, and its last known state.

    A final event outweighs a running one of the same moment.
    """
    last = F.struct(F.col("event_time"), is_final(F.col("status")), F.col("status"))
    final = is_final(F.col("status"))
    return events.groupBy("run_id").agg(
        F.max("source").alias("source"), F.max("trigger").alias("trigger"),
        F.min("event_time").alias("started_at"),
        F.max(F.when(final, F.col("event_time"))).alias("finished_at"),
        F.max_by("status", last).alias("status"), F.max_by("error", last).alias("error"))


def close_abandoned(events: DataFrame, at: Column, run_id: str | None = None, before: datetime | None = None) -> DataFrame:
    """Failure events for runs that are still running (one run, those that began ``before``, or all)."""
    states = run_states(events).where(F.col("status") == "running")
    if before is not None:
        states = states.where(F.col("started_at") < F.lit(before))
    if run_id is not None:
        states = states.where(F.col("run_id") == run_id)
    return states.select("run_id", "source", "trigger", F.lit("failed").alias("status"),
                         at.cast("timestamp").alias("event_time"), F.lit(None).cast("string").alias("error"))


def check_events(results: DataFrame, run_id: str, at: Column) -> DataFrame:
    return results.select(F.lit(run_id).alias("run_id"), at.cast("timestamp").alias("checked_at"), "*")


def latest_check_results(log: DataFrame) -> DataFrame:
    newest = log.agg(F.max_by("run_id", F.struct("checked_at", "run_id"))).scalar()
    return log.where(F.col("run_id") == newest)


def task_tables(tasks: DataFrame, task: str) -> DataFrame:
    """Per-table counts from the task details: newest entry per table with output."""
    entries = (tasks.where(F.col("task") == task)
                    .select("started_at", F.explode(F.from_json("details", DETAILS)["tables"]).alias("e"))
                    .where(F.col("e.rows_out") != 0)
                    .select("started_at", F.col("e.table").alias("table"), "e"))
    return (entries.groupBy("table").agg(F.max_by("e", F.struct("started_at", "e")).alias("e"))
                   .select("e.*"))
