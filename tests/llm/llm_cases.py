from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """The shared folder, where the session names none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def docs_of(spark, folder):
    """Documents from texts or (id, text) pairs, with columns whose names clash with those of results."""
    def make(texts, clashing=True):
        rows = [(k, t) if not isinstance(t, tuple) else t for k, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        return df.withColumn("kept", F.lit("x")).withColumn("digest", F.lit(1)).withColumn("slot", F.lit(2)) if clashing else df
    return make


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
