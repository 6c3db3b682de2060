"""Published versions that point to what did not change.

A version is a list of parts: folders with the rows of a table, or of one
partition of it, with their number, content sum and origin (what they were
derived from).  A new version names the parts of the one before wherever their
origin is the same, so a refresh writes the touched releases only.  Row counts,
releases and schemas are read from the version's entry, never from data.

```
<folder>/published/...json                                     one entry per version
<folder>/data/<table>/written=<version>/release_date=<day>/    parts by release
<folder>/data/<table>/written=<version>/part=<label>/          other parts
```
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import fingerprint
from tidemark.sources.lake import ROWS_PER_FILE

ENTRY = ("version string, published_at timestamp, tables map<string,bigint>, schemas map<string,string>, "
         "parts array<struct<table:string,name:string,folder:string,rows:bigint,content_sum:string,origin:string>>")


@dataclass(frozen=True)
class Part:
    """Rows of a table that live in one folder; a part without rows has no folder."""

    table: str
    name: str                   # release, or label
    folder: str
    rows: int
    content_sum: str
    origin: str


@dataclass(frozen=True)
class Version:
    """What a published entry says; all of it is in memory, a row per part."""

    version: str
    schemas: Mapping[str, T.StructType]
    parts: tuple[Part, ...]

    def of(self, table: str) -> dict[str, Part]:
        return {p.name: p for p in self.parts if p.table == table}

    @property
    def rows(self) -> dict[str, int]:
        return {t: sum(p.rows for p in self.of(t).values()) for t in self.schemas}

    def releases(self, table: str) -> list[str]:
        """Releases with rows, in order."""
        return sorted(p.name for p in self.of(table).values() if p.rows)


NOTHING = Version("", {}, ())


def _read(spark: SparkSession, folder: str, table: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
    """The rows of some parts; columns that an older part lacks are NULL there."""
    places = [f"{folder}/{p.folder}" for p in parts if p.folder]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/data/{table}").parquet(*places).select(*schema.names)


class Snapshot:
    """Tables of one version in the making, made visible together by ``commit``.

    Until then readers keep the version before, which is also the one that
    ``keep`` takes parts from.
    """

    def __init__(self, spark: SparkSession, folder: str, version: str) -> None:
        self.spark, self.folder, self.version = spark, folder, version
        known = published_or_none(spark, folder)
        if known is not None and not known.where(F.col("version") == version).isEmpty():
            raise ValueError(f"version {version} is published; what was published stays as it was")
        self.before = NOTHING if known is None else read_version(spark, folder)
        self.now = NOTHING
        self._lock = Lock()                             # tables are put side by side

    def stale(self, table: str, origins: Mapping[str, str]) -> list[str]:
        """Parts that are absent from the version before, or were derived from something else."""
        old = self.before.of(table)
        return sorted(n for n, origin in origins.items() if n not in old or old[n].origin != origin)

    def keep(self, table: str, names: Sequence[str] | None = None) -> DataFrame:
        """Point to parts of the version before (all of them by default)."""
        old = self.before.of(table)
        return self._add(table, self.before.schemas[table], [old[n] for n in (old if names is None else names)])

    def put(self, table: str, rows: DataFrame, label: str = "all", release: str | None = None,
            origins: Mapping[str, str] | None = None, cluster: str | None = None) -> DataFrame:
        """Write rows and hand back the whole table of this version as stored.

        With ``release`` every value of that date column is a part of its own, and the
        releases of ``origins`` that bring no rows are noted as parts without rows.
        Rows are sorted by ``cluster`` within each file and the column gets a bloom filter, so a
        lookup of one value skips row groups.
        """
        place = f"data/{table}/written={self.version}"
        ready = rows if release is None else rows.withColumnRenamed(release, "release_date")
        if cluster:
            by = [F.col("release_date"), F.col(cluster)] if release else [F.col(cluster)]
            ready = (ready.hint("rebalance", "release_date") if release else ready).sortWithinPartitions(*by)
        elif release:
            ready = ready.hint("rebalance", "release_date")
        where = f"{self.folder}/{place}" if release else f"{self.folder}/{place}/part={label}"
        writer = ready.write.mode("append" if release else "overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "zstd")
        if cluster:
            writer = writer.option(f"parquet.bloom.filter.enabled#{cluster}", "true")
        (writer.partitionBy("release_date") if release else writer).parquet(where)
        origins = dict(origins or {})
        if release is None:
            stored = self.spark.read.schema(rows.schema).parquet(where)
            n = fingerprint(stored, (), rows.columns).first()
            parts = [Part(table, label, f"{place}/part={label}", n["row_count"], n["content_sum"], origins.get(label, ""))]
        else:
            names = [c for c in rows.columns if c != release]
            counted = self._counts(where, ready.schema, names)
            parts = [Part(table, day, f"{place}/release_date={day}", n, total, origins.pop(day, "")) for day, n, total in counted]
            parts += [Part(table, day, "", 0, "0", origin) for day, origin in origins.items()]
        return self._add(table, rows.schema, parts)

    def _counts(self, where: str, schema: T.StructType, names: Sequence[str]) -> list[tuple[str, int, str]]:
        """``(release, rows, sum)`` of what was just written, one row per release."""
        try:
            stored = self.spark.read.schema(schema).parquet(where)
        except AnalysisException:                       # nothing was written
            return []
        found = fingerprint(stored.withColumn("release_date", F.col("release_date").cast("string")), ["release_date"], names).collect()
        return sorted((r["release_date"], r["row_count"], r["content_sum"]) for r in found)

    def _add(self, table: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
        new = {p.name for p in parts}
        with self._lock:
            rest = tuple(p for p in self.now.parts if not (p.table == table and p.name in new))
            self.now = replace(self.now, schemas={**self.now.schemas, table: schema}, parts=(*rest, *parts))
        return self.table(table)

    def drop(self, table: str) -> None:
        """Leave out what this version has of a table so far."""
        with self._lock:
            self.now = replace(self.now, schemas={t: s for t, s in self.now.schemas.items() if t != table},
                               parts=tuple(p for p in self.now.parts if p.table != table))

    def table(self, name: str) -> DataFrame:
        return _read(self.spark, self.folder, name, self.now.schemas[name], list(self.now.of(name).values()))

    def parts(self, name: str, some: Sequence[str]) -> DataFrame:
        """Only some parts of a table of this version: no other folder is opened."""
        of = self.now.of(name)
        return _read(self.spark, self.folder, name, self.now.schemas[name], [of[n] for n in some if n in of])

    def commit(self) -> Version:
        """Append the entry that makes the version visible."""
        row = (self.version, self.now.rows, {t: s.json() for t, s in self.now.schemas.items()}, [asdict(p) for p in self.now.parts])
        plain = "version string, tables map<string,bigint>, schemas map<string,string>, " + ENTRY.split("map<string,string>, ")[1]
        (self.spark.createDataFrame([row], plain).withColumn("published_at", F.current_timestamp())
             .coalesce(1).write.mode("append").json(f"{self.folder}/published"))
        self.now = replace(self.now, version=self.version)
        return self.now


def publish_snapshot(tables: Mapping[str, DataFrame], folder: str, version: str) -> Version:
    snapshot = Snapshot(next(iter(tables.values())).sparkSession, folder, version)
    for name, table in tables.items():
        snapshot.put(name, table)
    return snapshot.commit()


def published(spark: SparkSession, folder: str) -> DataFrame:
    """All entries: versions, when they were published, and what they hold."""
    return spark.read.schema(ENTRY).json(f"{folder}/published")


def published_or_none(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return published(spark, folder)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_version(spark: SparkSession, folder: str) -> str:
    return published(spark, folder).agg(F.max_by("version", F.struct("published_at", "version"))).first()[0]


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> Version:
    """A version's entry; the newest one by default."""
    entries = published(spark, folder)
    found = (entries.orderBy(F.desc("published_at"), F.desc("version")) if version is None else entries.where(F.col("version") == version)).first()
    if found is None:
        raise ValueError(f"no version {version} in {folder}")
    schemas = {t: T.StructType.fromJson(json.loads(s)) for t, s in found["schemas"].items()}
    return Version(found["version"], schemas, tuple(Part(**p.asDict()) for p in found["parts"]))


def open_snapshot(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """Register every table of a version as a temporary view of the same name."""
    entry = read_version(spark, folder, version)
    tables = {name: _read(spark, folder, name, schema, list(entry.of(name).values())) for name, schema in sorted(entry.schemas.items())}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def unreferenced(spark: SparkSession, folder: str, versions: Sequence[str]) -> list[str]:
    """Folders of parts that none of the given versions names; removing them leaves these versions whole."""
    entries = published(spark, folder).select("version", F.explode("parts.folder").alias("folder")).where("folder <> ''").distinct().collect()
    wanted = {e["folder"] for e in entries if e["version"] in set(versions)}
    return sorted({e["folder"] for e in entries} - wanted)
