"""Near-duplicates of texts and vectors, repeated units, components: against plain loops over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from llm_cases import by_id, docs_of, folder  # noqa: F401
from tidemark.llm.components import components
from tidemark.llm.near_duplicates import near_duplicates
from tidemark.llm.repeated_units import units, without_repeats
from tidemark.llm.vector_duplicates import Filters, near_vectors, plan_of


def least_reachable(nodes, pairs):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingle_sets(docs, width):
    sets = {}
    for k, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(width, len(words))
        sets[k] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()
    return sets


def brute_groups(docs, width, percent=80):
    sets = shingle_sets(docs, width)
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = least_reachable(sets, pairs)
    return {k: (len(sets[k]), found[k], found[k] == k) for k in sets}


def edited(words, changes, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, n_groups=12, copies=9):
    rng, texts = random.Random(seed), []
    for _ in range(n_groups):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 30, 120, 400]))]
        texts += [edited(words, rng.randrange(0, max(1, len(words) // 9)), rng) for _ in range(copies)]
        texts += [" ".join(words)] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(docs_of, width):
    docs = list(enumerate([*corpus(width), None, "", " \t ", "One", "one", "ONE two", "x " * 20_000, "y" * 100_000]))
    got = {k: (r["n_shingles"], r["component_id"], r["kept"]) for k, r in by_id(near_duplicates(docs_of(docs), width=width)).items()}
    assert got == brute_groups(docs, width)


def test_near_duplicates_of_a_chain(docs_of):
    """Neighbours are linked, ends are not: the group holds all of them."""
    rng = random.Random(4)
    words, texts = [f"w{k}" for k in range(200)], []
    for _ in range(25):
        texts.append(" ".join(words))
        words[rng.randrange(200)] = f"n{rng.randrange(10**6)}"
        words[rng.randrange(200)] = f"n{rng.randrange(10**6)}"
        words[rng.randrange(200)] = f"n{rng.randrange(10**6)}"
    docs = list(enumerate(texts))
    got = {k: (r["n_shingles"], r["component_id"], r["kept"]) for k, r in by_id(near_duplicates(docs_of(docs), width=2)).items()}
    assert got == brute_groups(docs, 2)


def test_near_duplicates_null_and_repeated_ids(docs_of):
    text = "a b c d e f g"
    rows = near_duplicates(docs_of([(None, text), (3, text), (3, text), (5, text)])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in rows) == [(0, None, True), (3, 3, True), (3, 3, True), (5, 3, False)]


def test_empty_tables(docs_of, spark):
    none = docs_of([("x", "x")][:0])
    assert near_duplicates(none).count() == 0
    assert without_repeats(none).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), max_size=25))
def test_components_equal_plain_search(spark, folder, pairs):
    got = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 1)], "a long, b long")).collect()}
    assert got == least_reachable({n for p in pairs for n in p}, pairs)


def test_components_of_a_long_path(spark, folder):
    got = components(spark.range(300).selectExpr("(id * 11) % 301 as a", "((id + 1) * 11) % 301 as b")).collect()
    assert len(got) == 301 and {r.component for r in got} == {0}


def brute_vectors(rows, cosine=0.9):
    def unit(v):
        if v is None or len(v) == 0 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.asarray(v, float)
        return v / np.linalg.norm(v)

    units_ = {k: unit(v) for k, v in rows}
    pairs = [(a, b) for a in units_ for b in units_ if a < b and units_[a] is not None and units_[b] is not None
             and len(units_[a]) == len(units_[b]) and units_[a] @ units_[b] >= cosine]
    found = least_reachable(units_, pairs)
    links = {k: sum(k in p for p in pairs) for k in units_}
    return {k: (links[k], found[k], found[k] == k) for k in units_}


def test_near_vectors_equal_all_pairs(spark, folder):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 64))
    rows = [base[k % 40] + rng.normal(0, 0.02 + 0.01 * (k % 40), 64) for k in range(400)]
    rows += [base[0]] * 30 + [2 * base[0], -base[0]]
    vectors = [[float(x) for x in v] for v in rows]
    vectors += [None, [], [0.0] * 64, [None] * 64, [float("nan")] * 64, [float("inf")] * 64, [1.0, 0.0], [0.9, 0.1], [-0.0, 1.0], [0.0, 1.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").selectExpr("*", "1 as kept", "'a' as key")
    got = {k: (r["n_links"], r["component_id"], r["kept"]) for k, r in by_id(near_vectors(table), "vec_id").items()}
    assert got == brute_vectors(list(enumerate(vectors)))


def test_recall_at_the_threshold(spark, folder):
    """Pairs just above cosine 0.9 are found."""
    rng, vectors = np.random.default_rng(5), []
    for _ in range(400):
        x, z = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        vectors += [x, 0.9005 * x + np.sqrt(1 - 0.9005**2) * z / np.linalg.norm(z)]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert sum(r.n_links for r in near_vectors(table).collect()) >= 2 * 0.995 * 400


@pytest.mark.parametrize("dim", [16, 64])
def test_recall_with_the_directions_of_millions(dim):
    """Pairs of cosine 0.9 share a filter at a number of codewords that belongs to 10 million vectors."""
    rng = np.random.default_rng(7)
    x, z = rng.standard_normal((2, 1000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.9**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    words, codes = plan_of(dim, 10**7)
    assert words >= 200 or dim < 64
    shared = np.zeros(1000, int)
    for code in range(codes):
        of = Filters(dim, words, code)
        a, b = (set(zip(*(part.tolist() for part in of.lists(v)), strict=True)) for v in (x, y))
        np.add.at(shared, [row for row, _ in a & b], 1)
    assert shared.min() > 0 and shared.mean() > 25


def brute_removed(docs):
    """Removed spans by id: units in order of id; a unit goes if the same one came before."""
    seen, out = set(), {}
    for k, text in sorted(docs, key=lambda d: d[0]):
        cuts = []
        for a, b, kind, normal in sorted(units(text), key=lambda u: u[0]):
            if (kind, normal) in seen:
                cuts.append((a, -b))
            seen.add((kind, normal))
        kept = []
        for a, b in sorted(cuts):
            if not kept or a >= kept[-1][1]:
                kept.append((a, -b))
        out[k] = kept
    return out


def test_repeated_units_equal_a_plain_pass(docs_of):
    rng = random.Random(8)
    stock = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(2, 14))) + "." for _ in range(60)]
    docs = [(k, "\n".join(" ".join(rng.sample(stock, rng.randrange(1, 4))) for _ in range(rng.randrange(1, 6)))) for k in range(60)]
    docs += [(90, None), (91, ""), (92, "\n\n"), (93, stock[0].upper() + "\n" + stock[1] * 3000), (94, "short line\nshort line")]
    found = by_id(without_repeats(docs_of(docs)))
    want = brute_removed(docs)
    assert {k: [(s["first"], s["last"]) for s in r["removed"]] for k, r in found.items()} == want
    for k, text in docs:
        cut = want[k]
        if not cut:
            assert found[k]["text"] == text
        else:
            assert len(found[k]["text"]) <= len(text) - sum(b - a for a, b in cut)
    assert {r["digest"] for r in found.values()} == {1}


def test_a_passage_inside_other_lines_goes(docs_of):
    passage = "Once there was a very long story here. It went on for many words without end. Nobody knew where it came from."
    found = by_id(without_repeats(docs_of([f"before it {passage} after it", f"quite another start {passage} and end", "a b c d e f. clean text of its own here."])))
    assert found[0]["removed"] == [] and found[2]["removed"] == []
    assert "went on for many words" not in found[1]["text"] and found[1]["text"].startswith("quite another start")


def test_repeated_lines_leave_their_break(docs_of):
    line, other = "one two three four five", "six seven eight nine ten"
    found = by_id(without_repeats(docs_of([f"{line}\n{other}", f"{line}\nown words of this text here", f"own start of this text\n{other.upper()}", f"{line}\n{other}"])))
    assert [found[k]["text"] for k in range(4)] == [f"{line}\n{other}", "own words of this text here", "own start of this text", ""]


def test_text_moves_once_beside_the_other_columns(docs_of):
    """The row that is joined with its cuts holds the text once; more texts than a slice are all cut, in their places."""
    line = "this line of six words stays"
    rows = without_repeats(docs_of([(k, None if k % 7 == 3 else f"{line}\nnumber {k} has five words here") for k in range(1200)]).coalesce(1))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "AS row#" in plan and not re.search(r"struct\([^()]*\btext#\d+[^()]*\) AS row#", plan)
    found = by_id(rows)
    assert len(found) == 1200 and found[3]["text"] is None and found[0]["text"].startswith(line) and found[0]["removed"] == []
    assert all(found[k]["text"] == f"number {k} has five words here" and found[k]["removed"] == [{"first": 0, "last": len(line)}] for k in range(1, 1200) if k % 7 != 3)


def test_a_whole_line_meets_an_inner_sentence(docs_of):
    one = "This sentence stands here on a line of its own."
    found = by_id(without_repeats(docs_of([one, f"First comes another short start. {one} Then an end of some words.", f"own words of this text here\n{one.upper()}\nx"])))
    assert found[0]["text"] == one and one not in found[1]["text"] and found[2]["text"] == "own words of this text here\nx"
    found = by_id(without_repeats(docs_of([f"First comes another short start. {one}", f"own words of this text here\n{one}\nx"])))
    assert found[0]["removed"] == [] and found[1]["text"] == "own words of this text here\nx"


def test_repeats_in_scripts_without_spaces(docs_of):
    one, other = "これは何度も繰り返される長い文章の一つであって、どこにでもある。", "別の文章がここに一つだけあるので、残るはずである。"
    found = by_id(without_repeats(docs_of([f"{one}{other}", f"短い。{one}ここは別の終わり方をするので、そのまま残る。", f"{one * 20}", "短い。", "短い。"])))
    assert [found[k]["text"] for k in (0, 3, 4)] == [f"{one}{other}", "短い。", "短い。"]
    assert found[1]["text"] == "短い。ここは別の終わり方をするので、そのまま残る。" and found[2]["text"] == ""


def test_repeats_beside_any_names(docs_of):
    line = "one two three four five"
    docs = docs_of([line, line]).select("*", *[F.lit("x").alias(c) for c in ("Removed", "__digest", "__some", "__cut", "cut", "row", "its_id", "high")])
    found = by_id(without_repeats(docs))
    assert found[1]["text"] == "" and found[1]["removed"] and found[0]["its_id"] == found[1]["row"] == "x"


def test_repeats_with_null_and_equal_ids(docs_of):
    line = "one two three four five"
    rows = without_repeats(docs_of([(None, line), (2, line), (2, line)])).collect()
    assert sorted((r.doc_id or 9, r.text) for r in rows) == [(2, line), (2, line), (9, "")]


def test_large_buckets_go_on_in_blocks(docs_of, monkeypatch):
    """Copies that are near a common text but often not near each other."""
    monkeypatch.setattr("tidemark.llm.near_duplicates.PIVOTS", (1, 2))
    monkeypatch.setattr("tidemark.llm.near_duplicates.BLOCK", 7)
    rng, texts = random.Random(5), []
    for n in (60, 150):
        words = [f"w{rng.randrange(5000)}" for _ in range(n)]
        texts += [edited(words, rng.randrange(0, n // 14), rng) for _ in range(70)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = {k: (r["n_shingles"], r["component_id"], r["kept"]) for k, r in by_id(near_duplicates(docs_of(docs), width=2)).items()}
    assert got == brute_groups(docs, 2)
