"""Tables of the chain, built once per session and test folder.

A refresh writes silver and facts before anything reads them; queries here do
the same in the shared folder, so each one runs its own model on stored input
instead of repeating the whole chain.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from contextlib import AbstractContextManager, nullcontext
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from bindings import feeds
from tidemark.plans import gold, silver
from tidemark.session import WIDE_ROWS, shared_folder, shuffles_for, with_settings
from tidemark.sources import lake
from tidemark.sources.feeds import measure_catalog, state_regions

#: Rows of a file of a feed, and at most those of a part of a shuffle on average: a task reads one such file (by the limit of
#: ``WIDE_ROWS``) or gathers one such part, whose rows sort in some 100 MB.
FEED_ROWS = 250_000
MEASURE_FEEDS = ("complications_deaths", "unplanned_visits")

_OPEN: dict[tuple[str, str], Chain] = {}


def chain(spark: SparkSession, sf_dir: str) -> Chain:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Chain(spark, sf_dir.rstrip("/"))
    return _OPEN[key]


class Chain:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._landed: dict[str, DataFrame] = {}
        label = re.sub(r"[^A-Za-z0-9]+", "-", sf_dir).strip("-")
        self.folder = f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}/{label}"

    def table(self, name: str) -> DataFrame:
        return feeds.table(self.spark, self.sf_dir, name)

    def bronze(self, feed: str) -> DataFrame:
        """A feed as delivered: all rows derived from the test tables, stored once by the tasks that derive them; the wide text is not moved."""
        if feed not in self._landed:
            self._landed[feed] = self._stored(f"bronze/{feed}", lambda: feeds.bronze(self.spark, self.sf_dir, feed), codec="snappy", rows=FEED_ROWS)
        return self._landed[feed]

    def scratch(self, name: str) -> str:
        """A new folder for a query that writes."""
        return f"{self.folder}/scratch/{name}-{uuid.uuid4().hex[:8]}"

    def newest(self, name: str) -> str:
        """The newest release of a stored table, by folder names."""
        getattr(self, name)
        return max(f["release_date"] for f in lake.partition_folders(self.spark, f"{self.folder}/{name}"))

    def dealt(self, *names: str) -> AbstractContextManager[None]:
        """Settings for shuffles of the rows of these feeds, which are counted by the footers of their files."""
        rows = sum(self.bronze(n).count() for n in names)
        return with_settings(self.spark, shuffles_for(self.spark, rows, FEED_ROWS)) if names else nullcontext()

    def _stored(self, name: str, build: Callable[[], DataFrame], by_release: bool = False, codec: str = "zstd", rows: int = 0,
                of: tuple[str, ...] = ()) -> DataFrame:
        """A table written by the tasks that hold its rows: no shuffle and no sort for the folders; ``rows`` bounds a file, ``of`` are its feeds."""
        with self.dealt(*of):
            path, table = f"{self.folder}/{name}", build()             # building may store tables too, such as pieces of values
            writer = table.write.mode("overwrite").option("compression", codec).option("maxRecordsPerFile", rows)
            with with_settings(self.spark, WIDE_ROWS):
                (writer.partitionBy("release_date") if by_release else writer).parquet(path)
        return self.spark.read.schema(table.schema).parquet(path).select(*table.columns)

    @cached_property
    def regions(self) -> DataFrame:
        return state_regions(self.spark)

    @cached_property
    def catalog(self) -> DataFrame:
        return measure_catalog(self.spark)

    @cached_property
    def hospitals(self) -> DataFrame:
        return self._stored("hospitals", lambda: silver.silver_hospitals(self.bronze("hospital_info")), by_release=True, of=("hospital_info",))

    @cached_property
    def measure_scores(self) -> DataFrame:
        parts = {n: self.bronze(n) for n in MEASURE_FEEDS}
        return self._stored("measure_scores", lambda: silver.silver_measures(parts), by_release=True, of=MEASURE_FEEDS)

    @cached_property
    def hcahps(self) -> DataFrame:
        return self._stored("hcahps", lambda: silver.silver_survey(self.bronze("hcahps")), by_release=True, of=("hcahps",))

    @property
    def stg_hospitals(self) -> DataFrame:
        return gold.stg_hospitals(self.hospitals)

    @property
    def stg_measures(self) -> DataFrame:
        return gold.stg_measure_scores(self.measure_scores)

    @property
    def stg_survey(self) -> DataFrame:
        return gold.stg_survey(self.hcahps)

    @cached_property
    def facts(self) -> DataFrame:
        return self._stored("facts", lambda: gold.fct_measure_scores(self.stg_measures, self.catalog), by_release=True, of=MEASURE_FEEDS)

    @cached_property
    def history(self) -> DataFrame:
        return self._stored("history", lambda: gold.dim_hospital_history(
            gold.hospital_versions(self.stg_hospitals), self.regions), of=("hospital_info",))

    @cached_property
    def dim(self) -> DataFrame:
        return self._stored("dim", lambda: gold.dim_hospital(self.stg_hospitals, self.regions))

    @cached_property
    def measures(self) -> DataFrame:
        return self._stored("measures", lambda: gold.dim_measure(self.stg_measures, self.catalog))

    @cached_property
    def experience(self) -> DataFrame:
        return self._stored("experience", lambda: gold.survey_pivot(self.stg_survey), by_release=True, of=("hcahps",))

    @cached_property
    def scorecard(self) -> DataFrame:
        return self._stored("scorecard", lambda: gold.hospital_scorecard(
            self.dim, self.facts, self.experience, self.stg_hospitals))

    @cached_property
    def benchmarks(self) -> DataFrame:
        return self._stored("benchmarks", lambda: gold.measure_benchmarks(self.facts, self.measures))

    @cached_property
    def states(self) -> DataFrame:
        return self._stored("states", lambda: gold.state_summary(self.scorecard))
