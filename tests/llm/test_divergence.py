"""Distances of sources against sums over all terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from llm_cases import folder  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm.divergence import Tree, divergence, share, terms_of

DOCS = "doc_id long, text string, lang string, source string"


def brute(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
            for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        owners, groups = Counter(), defaultdict(Counter)
        for _, source, words in (d for d in docs if d[0] == lang):
            owners.update(set(words))
            groups[source].update(words)
        kept = [t for t, n in owners.items() if n >= least]

        def shares(counts):
            all_ = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // all_ for t in kept}

        def far(p, q):
            return (p - q)**2 // (p + q)

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top if part == "term" else None]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def found(df, least, top=10):
    return [tuple(r) for r in divergence(df, least_docs=least, top=top).select("lang", "source", "part", "item", "value", "rank").collect()]


def test_against_all_terms(spark, folder):  # noqa: F811
    lot, words = random.Random(3), ["The", "a", "été", "x", "zwei", "ÀB", "日本", "b1c", "q-r", "ab"]
    rows = [(k, lot.choice([None, "", " ".join(lot.choices(words, k=lot.randrange(40))), "12 !?"]) if k % 7 == 0 else " ".join(lot.choices(words, k=30)),
             lot.choice(["en", "en", "en", None, "fr"]), lot.choice(["s1", "s2", None, "S3", "é", "s10"])) for k in range(300)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(c) for c in ("term", "n", "part", "VALUE", "a")]).repartition(5)
    for least, top in ((10, 10), (1, 3), (90, 10), (10_000, 10)):
        got = found(df, least, top)
        assert len(got) == len(set(got)) and set(got) == brute(rows, least, top)


def test_odd_tables(spark, folder):  # noqa: F811
    assert found(spark.createDataFrame([], DOCS), 1) == []
    assert found(spark.createDataFrame([(1, None, None, None)], DOCS), 1) == []
    rows = [(1, "ab " * 100_000, "en", "s"), (2, "x" * 200_000 + " ab", "en", "t"), (None, "", "en", "u")]
    assert set(found(spark.createDataFrame(rows, DOCS), 1)) == brute(rows, 1, 10)


def test_shares_of_large_counts(spark):
    counts = [0, 1, 2**40, 2**62]
    df = spark.createDataFrame([(c, 2**62 + 11) for c in counts], "n long, total long")
    assert [r[0] for r in df.select(share("n", "total")).collect()] == [1 + 10**9 * (c + 2) // (2**62 + 11) for c in counts]


def test_tree_shares_paths():
    """Corrections of the tree are those of the rows one by one, in whatever parts they come."""
    lot = random.Random(2)
    absent = {"a": 7, "b": 11, "c": 3, "d": 5}
    rows = sorted([(s, lot.randrange(1, 4) * 100, absent[s]) for s in sorted(lot.sample("abcd", lot.randrange(1, 5)))] for _ in range(200))
    terms = [lot.randrange(1, 9) for _ in rows]

    def far(p, q):
        return (p - q)**2 // (p + q)

    want = Counter()
    for row, n in zip(rows, terms, strict=True):
        for k, (s, p, p0) in enumerate(row):
            for o, q, q0 in row[:k]:
                want[o, s] += n * (far(p, q) - far(p, q0) - far(p0, q) + far(p0, q0))
    for size in (1, 7, 200):
        tree = Tree()
        for k in range(0, len(rows), size):
            tree.add(rows[k:k + size], terms[k:k + size])
        assert {(a, b): v for a, b, v in tree.take()} == dict(want)


def test_terms():
    assert [t.decode() for t in terms_of("Don't É2x_Y日本 --")] == ["don", "t", "É", "x", "y日本"] and terms_of(None) == []
