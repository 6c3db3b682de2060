"""Named queries, each with its SQL counterpart where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bindings import oracle
from bindings.tables import Chain, chain


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    build: Callable[[Chain], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(chain(spark, sf_dir))


ENTRIES: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None):
    """Register ``build(chain)`` under ``name``; ``covers`` lists inventory ids."""
    def register(build: Callable[[Chain], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, covers, build, None if sql is None else oracle.query(sql))
        return build
    return register
