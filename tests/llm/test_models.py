"""Fitted models: gradients, held-out accuracy, odd input."""

from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_cases import by_id, docs_of, folder  # noqa: F401
from tidemark.llm import language, toxicity
from tidemark.llm.language import UNKNOWN, Network, _symbols, fit_languages, least_score, lot_of, predictor, with_language
from tidemark.llm.toxicity import Classifier, features_of, fit_toxicity, swapped, with_toxicity, words_of

SF, MORE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


def test_gradient_equals_differences():
    network = Network(["a", "b", "c"], hidden=3)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    x, y = _symbols([b"abca", b"zzba", b"acbd"]), np.array([0, 2, 1])
    _, slopes = network.slopes(x, y)
    rng = np.random.default_rng(0)
    for name, w in network.weights.items():
        rows = np.unique(x) if name.endswith("_in") else np.arange(len(w))
        for _ in range(6):
            at = (rng.choice(rows), *[rng.integers(n) for n in w.shape[1:]])
            was, step = w[at], 1e-3
            w[at] = was + step
            up, _ = network.slopes(x, y)
            w[at] = was - step
            down, _ = network.slopes(x, y)
            w[at] = was
            assert abs((up - down) / (2 * step) - slopes[name][at]) < 2e-4


@needs_tables
def test_languages_held_out(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held", lot_of(F.col("doc_id"), 4) == 2)
    rows = with_language(docs, fit_languages(docs.where("not held"))).where("held").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_texts(docs_of, spark):
    network = Network(["en", "fr"]).fit([b"the", b"les"] * 40, [0, 1] * 40, steps=60)
    texts = [None, "", " \n", "12 34 !!", "the the", "les les", "日本", "the" * 50_000, "the the"]
    found = by_id(with_language(docs_of(texts), network))
    assert [found[k]["lang_pred"] for k in range(4)] == [UNKNOWN] * 4 and found[0]["score"] == 0.0
    assert (found[4]["lang_pred"], found[5]["lang_pred"]) == ("en", "fr") and found[4]["score"] == found[8]["score"]
    assert with_language(docs_of(texts).where("false"), network).count() == 0
    nothing = fit_languages(docs_of([None, ""]))
    assert nothing.labels == [] and predictor(nothing)(["the"]) == [(UNKNOWN, 0.0)]
    named = by_id(with_language(docs_of(texts).withColumn("Score", F.lit(1)).withColumn("lang_pred", F.lit("x")), network))
    assert all(named[k][c] == found[k][c] for k in found for c in ("lang_pred", "score")) and "Score" not in named[0]


def test_long_words_teach_in_all_their_parts(docs_of):
    """Two languages whose words share their first 40 bytes: only what comes after tells them apart."""
    start = "a" * 40
    docs = docs_of([(k, f"{start}{'bcd' if k % 2 else 'xyz'} " * 20) for k in range(60)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr"))
    predict = predictor(fit_languages(docs))
    assert [label for label, _ in predict([start + "bcd", start + "xyz"])] == ["en", "fr"]


def test_all_texts_teach(docs_of, monkeypatch):
    """Each of 700 texts of a language counts, whatever lot its words are dealt into."""
    def spelt(k):
        return "".join(("abcdefghij" if k % 2 else "qrstuvwxyz")[int(c)] for c in f"{k:05d}")

    rows = [(k, f"{'add a' if k % 2 else 'tu es'} {spelt(k)} é" + " 12" * (k % 3)) for k in range(1400)]
    docs = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr"))
    uses = {(r.label, r.kind, bytes(r.key).decode()): r.n for r in language._taught(docs, "doc_id", "text", "lang").collect()}
    want = Counter(("en" if k % 2 else "fr", "w", w) for k, t in rows for w in t.split())
    assert {k: n for k, n in uses.items() if k[1] == "w"} == want and uses["en", "t", ""] == 700 == uses["fr", "c", "é"]
    assert sum(kind == "d" for _, kind, _ in uses) == 2 * 700 + 2 + 2 + 2
    monkeypatch.setattr(language, "PARTS_PER_LOT", 200)
    network = fit_languages(docs)
    assert [label for label, _ in predictor(network)([spelt(9001), spelt(9002)])] == ["en", "fr"] and {"a", "é", "z"} <= network.known


def test_only_what_is_asked_for_is_counted(docs_of):
    """Fitting needs no list of distinct words, and the limit nothing but it: each counts its own kinds alone."""
    docs = docs_of(["add a 12 " + "é" * 50, None, " "]).withColumn("lang", F.lit("en"))
    counted = {kinds: {(r.kind, bytes(r.key), r.n) for r in language._taught(docs, "doc_id", "text", "lang", kinds).collect()} for kinds in ("wct", "d", "wctd")}
    assert {k for k, _, _ in counted["wct"]} == {"w", "c", "t"} and {k for k, _, _ in counted["d"]} == {"d"}
    assert counted["wctd"] == counted["wct"] | counted["d"] and ("w", ("é" * 20).encode(), 2) in counted["wct"]


def test_whole_texts_teach(docs_of):
    """What tells the languages apart stands at the end of long texts."""
    docs = docs_of([(k, "same words " * 300 + ("thorn" if k % 2 else "épine") * 1) for k in range(80)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr"))
    assert "é" in fit_languages(docs).known


@needs_tables
def test_texts_in_no_language_are_rejected(spark, folder):
    """Text of unknown scripts and junk with a letter go although they claim a language; every text of the table stays."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = ["日本語の文章です。これは長い文です。", "Это русский текст, написанный кириллицей.", "مرحبا بالعالم هذا نص عربي", "12 34 a !! 99 -- 55"]
    rows = spark.createDataFrame([(10**6 + k, t, "en", "s", len(t)) for k, t in enumerate(odd)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(rows), SF).collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}
    held = lot_of(F.col("doc_id"), 4) == 2
    network = fit_languages(docs.where(~held))
    assert 1.1 / 4 < least_score(network, docs.where(held)) < 0.35 and least_score(network, docs.where("false")) == 0.0


def test_lots(spark):
    import zlib

    rows = spark.createDataFrame([(k,) for k in (0, 7, 123456, -3)], "k long").select("k", lot_of(F.col("k"), 4).alias("lot")).collect()
    assert all(r.lot == zlib.crc32(str(r.k).encode()) % 4 for r in rows)


@needs_tables
def test_toxicity_held_out(spark, folder):
    """Recall grows with the labels: the smaller tables hold too few toxic words to learn."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    docs = docs.withColumn("held", lot_of(F.col("doc_id"), 3) == 1)
    classifier = fit_toxicity(docs.where("not held"), labels)
    rows = with_toxicity(docs, classifier).where("held").join(labels, "doc_id").select("toxic", "score").collect()
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([b > g for b in bad for g in good]) > 0.95 and np.mean([g >= 0.7 for g in good]) < 0.02


def named_corpus():
    """A toxic word decides; toxic texts happen to mention one group far more often."""
    rng, texts, labels = random.Random(5), [], []
    for k in range(400):
        toxic = k % 2
        words = [f"w{rng.randrange(80)}" for _ in range(12)]
        if toxic and rng.random() < 0.75:
            words.append("vile")
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("muslims")
        elif rng.random() < 0.5:
            words.append("christians")
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(toxic)
    return texts, labels


def fitted(fair):
    texts, labels = named_corpus()
    rows = lambda t: np.unique([f for w in words_of(t) for f in features_of(w)])
    pairs = [(rows(t), rows(s)) for k, t in enumerate(texts) if (s := swapped(t, k)) is not None]
    return Classifier(fair).fit([rows(t) for t in texts], labels, pairs).scorer()


def test_neutral_mentions_are_not_flagged():
    mention = ["the muslims met at w1 w2", "the christians met at w1 w2"]
    plain, fair = fitted(0.0)(mention), fitted(50.0)(mention)
    assert plain[0] - plain[1] > 0.4 and abs(fair[0] - fair[1]) < 0.5 * (plain[0] - plain[1])
    assert fair[0] < plain[0] and fitted(50.0)(["vile w1 w2"])[0] > fitted(50.0)(["w1 w2"])[0]


@needs_tables
def test_penalty_acts_on_the_tables(spark, folder):
    """Every sampled text has a pair; without the penalty the weights are others, with it neutral mentions score alike."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    some = docs.where(lot_of(F.col("doc_id"), 3) != 1)
    fair, plain = fit_toxicity(some, labels), fit_toxicity(some, labels, fair=0.0)
    assert not np.array_equal(fair.weights, plain.weights)

    def gaps(classifier):
        score = classifier.scorer()
        return [max(found) - min(found) for row in toxicity.IDENTITY_TERMS for found in [score([f"the {w} met here" for w in row])]]

    assert max(gaps(fair)) <= 0.01 and max(gaps(plain)) > max(gaps(fair))


def test_counterfactuals_differ_in_the_group_only():
    for lot in range(500):
        a, b = toxicity.counterfactual("no group here", lot)
        one, two = a.split("\n")[1], b.split("\n")[1]
        assert a != b and any(one in row and two in row for row in toxicity.IDENTITY_TERMS)
    assert toxicity.counterfactual("the Women", 0) == ("the Women", "the men")


def test_classes_count_as_in_the_table(spark, docs_of, folder):
    """A capped class still counts by its number of labelled texts: the score of a text without features follows the ratio."""
    docs = docs_of([(k, "x") for k in range(600)])
    labels = spark.createDataFrame([(k, int(k < 60)) for k in range(600)], "doc_id long, toxic int")
    found = [with_toxicity(docs.limit(1), fit_toxicity(docs, labels, texts=n)).first().score for n in (60, 600)]
    assert abs(found[0] - found[1]) < 0.02 and found[1] < 0.2


def test_swaps_stay_in_their_row():
    for row in toxicity.IDENTITY_TERMS:
        for lot in range(8):
            other = swapped(f"The {row[0].upper()}, here", lot)
            assert other[4:-6] in row[1:]
    assert swapped("nobody named", 0) is None


def test_toxicity_of_odd_texts(docs_of, spark):
    docs = docs_of([(0, "vile thing"), (1, "fine thing"), (2, None), (3, ""), (4, "vile thing"), (None, "vile"), (6, "vile " * 40_000)])
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 0), (2, 1), (4, 1), (9, 1), (3, None), (None, 1), (6, 1)], "doc_id long, toxic int")
    for fit in (fit_toxicity(docs, labels), fit_toxicity(docs, labels.where("false")), fit_toxicity(docs.where("false"), labels)):
        rows = with_toxicity(docs, fit).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not r.text}) == 1
    assert with_toxicity(docs.where("false"), Classifier()).count() == 0
