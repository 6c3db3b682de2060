"""Every stage of the pipeline on the rows that the stage before kept, against plain loops."""

from __future__ import annotations

import os

import numpy as np
import pytest
from llm_cases import by_id, docs_of, folder  # noqa: F401
from pyspark.sql import functions as F
from test_groups import brute_groups, brute_removed
from test_texts import brute_hits

import corpus_pipeline as pipeline
from tidemark.llm.language import UNKNOWN, fit_languages, least_score, lot_of, predictor
from tidemark.llm.pieces import Codec
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.store import stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


def texts(df):
    return {k: r["text"] for k, r in by_id(df).items()}


@pytest.fixture(scope="module")
def stages(spark, folder):  # noqa: F811
    """Documents with odd rows added, and what each stage stored."""
    odd = [(10_001, None), (10_002, ""), (10_003, "12 34 !!"), (10_004, "and the " * 9000)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(k, t, "en", "s", 0) for k, t in odd], docs.schema))
    clashing = ("label", "Score", "found", "removed", "Removed1", "cut", "digest", "id", "kept", "its_text", "__digest")
    docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(clashing)])
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_language_stage(stages):
    held = F.coalesce(lot_of(F.col("doc_id"), 4) == 2, F.lit(False))
    network = fit_languages(stages[0].where(~held))
    docs, limit = texts(stages[0]), least_score(network, stages[0].where(held))
    want = {k for k, (label, score) in zip(docs, predictor(network, evidence=True)(list(docs.values())), strict=True) if label != UNKNOWN and score >= limit}
    assert set(texts(stages[1])) == want and not {10_001, 10_002, 10_003} & want and len(want) >= len(docs) - 5


def test_near_duplicate_stage(stages):
    docs = texts(stages[1])
    want = {k for k, (_, _, kept) in brute_groups(sorted(docs.items()), 5).items() if kept}
    assert texts(stages[2]) == {k: docs[k] for k in want} and len(want) < len(docs)


def test_repeated_units_stage(stages):
    before, after = texts(stages[2]), texts(stages[3])
    cuts = brute_removed(list(before.items()))
    assert set(before) == set(after)
    for k, text in before.items():
        assert (after[k] == text) == (not cuts[k])
        for a, b in cuts[k]:
            assert after[k].count(text[a:b]) < text.count(text[a:b])
    assert all(r["n_chars"] == len(r["text"]) for r in by_id(stages[3]).values())


def test_decontamination_stage(stages, spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = texts(stages[3])
    assert set(texts(stages[4])) == {k for k, t in docs.items() if brute_hits(t, items)[1] == 0}


def test_piece_stage(stages):
    codec, docs = Codec(tokenizer_file("piece_bpe_32k.model")), texts(stages[4])
    found = by_id(stages[5])
    assert {k: bytes(r["ids"]) for k, r in found.items()} == dict(zip(docs, codec.encode_all(list(docs.values())), strict=True))
    assert all(r["same_text"] and r["n_pieces"] == len(np.frombuffer(r["ids"], "<u4")) for r in found.values())


def test_stages_of_no_documents(stages, spark):
    docs = stages[0].where("false")
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"none-{name}")
        assert docs.count() == 0


def test_tables_of_a_stage_go_after_it(spark, folder, monkeypatch):  # noqa: F811
    """A run leaves the last stage's table only."""
    def twice(spark_, docs, _):
        return stored(docs.where("doc_id % 2 = 0"), "on the way").limit(50)

    monkeypatch.setattr(pipeline, "STAGES", [("one", twice), ("two", twice)])
    top = f"{folder}/llm/{spark.sparkContext.applicationId}"
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    out = pipeline.run(spark, SF)
    assert out.count() == 50 and len(set(os.listdir(top)) - before) == 1
