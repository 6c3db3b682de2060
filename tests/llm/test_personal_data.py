"""Rules against plain patterns, and chosen spans in texts with known ones."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from llm_cases import by_id, docs_of, folder  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.personal_data import KINDS, Chooser, Trees, calibrated, fit_chooser, luhn, proposals, rule_spans, with_personal_data

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2]) + sum(digits[::-2])
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 12 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if fits:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def test_rules_equal_patterns():
    lot = random.Random(1)
    letters = ["a", "B", "@", ".", "-", "+", " ", "(", ")", "0", "1", "5", "9", "255", "4111111111111111", "é", "\n", "256", "00", "%", "12"]
    for _ in range(6000):
        text = "".join(lot.choices(letters, k=lot.randrange(30)))
        assert rule_spans(text) == brute(text), text
    assert rule_spans(None) == rule_spans("") == []


@needs_tables
def test_query_on_the_table(spark, folder):  # noqa: F811
    """The rules' columns of the whole table, and every added span beside them."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = by_id(queries.op12_personal_data(spark, SF))
    assert set(found) == set(texts)
    for k, text in texts.items():
        base = brute(text)
        listed = [f"{c}:{a}:{b}" for a, b, c in base]
        assert found[k]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [found[k][f"n_{c}"] for c in KINDS] == [sum(s[2] == c for s in base) for c in KINDS]
        spans = [s for s in found[k]["spans"].split(",") if s]
        assert set(listed) <= set(spans) and len(spans) == len(base) + found[k]["n_added"]
        added = [(int(a), int(b)) for c, a, b in (s.split(":") for s in spans) if f"{c}:{a}:{b}" not in listed]
        assert not any(a < e and s < b for a, b in added for s, e, _ in base)
        for a, b in added:                               # in this table: numbers of people that run into the next number
            assert luhn(re.sub("[^0-9]", "", text[a:b])) or text[a] == "+"
    clean = [k for k, t in texts.items() if not re.search("[0-9@]", t or "")]
    assert len(clean) > 100 and not any(found[k]["spans"] for k in clean)


@pytest.fixture(scope="module")
def chooser(spark, folder):  # noqa: F811
    return fit_chooser(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


@needs_tables
def test_other_spellings_are_chosen(chooser):
    lot = random.Random(5)
    hits, all_, wrong, clean = 0, 0, 0, 0
    for _ in range(300):
        a, b, c = (lot.randrange(100, 1000) for _ in range(3))
        number = [lot.randrange(10) for _ in range(15)]
        number.append(next(d for d in range(10) if luhn("".join(map(str, [*number, d])))))
        card = "".join(map(str, number))
        cases = {"email": f"anna{a} (at) post.example.org", "ip": f"{lot.randrange(10, 255)}[.]{lot.randrange(255)}[.]{lot.randrange(255)}[.]{lot.randrange(1, 255)}",
                 "card": f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}", "phone": f"({a}) {b}-{c}{lot.randrange(10)}"}
        for kind, body in cases.items():
            lead = f"the one of them {lot.choice(['was ', 'had: ', 'in '])}"
            got = chooser.chosen([f"{lead}{body} and then more"])[0]
            hits += any(s[:3] == (len(lead), len(lead) + len(body), kind) for s in got)
            all_ += 1
        for body in ("in 1998 and 2004", f"version {a}.{b}", f"sum of {a} 000", f"we met at home. Then {a}", f"page {a}, {b}, {c}"):
            wrong += bool(chooser.chosen([f"it was {body} that he said"])[0])
            clean += 1
    assert hits / all_ > 0.75 and wrong / clean < 0.02, (hits / all_, wrong / clean)


@needs_tables
def test_numbers_that_run_together(chooser):
    card, phone = "4111 1111 1111 1111".replace(" ", ""), "+1 (663) 555-6869"
    text = f"one {card} {card} two {phone} 12.34.56.78 three"
    got = {text[a:b]: kind for a, b, kind, _ in chooser.chosen([text])[0]}
    assert got == {card: "card", phone: "phone"} and [s[2] for s in rule_spans(text)] == ["ip"]


def test_odd_texts(spark, docs_of, folder):  # noqa: F811
    texts = [None, "", "a@b.cd", "a@b.cd", "5" * 200_000, "a" * 200_000, "1.1.1.1." * 20_000, "@" * 50_000, "+" * 50_000, "+1" + "(" * 100_000, "٣@日.本", "1 2 " * 30_000]
    docs = docs_of(texts).select("*", F.lit("x").alias("Personal"), F.lit("y").alias("base"))
    start = time.time()
    found = by_id(with_personal_data(docs, fit_chooser(docs), redacted="clean"))
    assert time.time() - start < 120 and len(found) == len(texts)
    assert found[0]["personal"] == {"base": [], "added": []} and found[0]["clean"] is None and found[1]["clean"] == ""
    assert found[2]["clean"] == found[3]["clean"] == "[EMAIL]" and found[2]["base"] == "y" and "Personal" not in found[2]
    assert with_personal_data(docs.where("false"), Chooser({})).count() == 0
    assert fit_chooser(docs.where("false")).kinds == {}


def test_proposals_overlap_and_hold_the_rules_spans():
    text = "mail a.b@c.de or +49 (30) 555-1234, 10.0.0.1 and 4111-1111-1111-1111."
    spans = set(proposals(text))
    assert {(a, b, k) for a, b, k in rule_spans(text)} <= spans and len(spans) > 5


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = Trees().fit(x[:2000], y[:2000])
    margins = trees.margins(x[2000:])
    assert ((margins > 0) == y[2000:]).mean() > 0.95
    steps, shares = calibrated(margins, y[2000:])
    assert steps == sorted(steps) and shares == sorted(shares) and 0 <= shares[0] <= shares[-1] <= 1
    assert calibrated(np.array([1.0, 1.0, 2.0]), np.array([1.0, 0.0, 1.0])) == ([1.0, 2.0], [0.5, 1.0])
