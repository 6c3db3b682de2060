"""Repair of conversations against all possible edits."""

from __future__ import annotations

import hashlib
import random
import re

import pandas as pd
import pytest
from llm_cases import folder  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import conversations as C
from tidemark.llm.store import stored

ROWS = "conv_id long, turn long, role string, text string"
OTHER = {"": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}


def faults_of(rows):
    """``(role, text, fault)`` in order; the first fault of a row counts."""
    def key(r):
        text = " " if r[3] is None else r[3]
        return (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], hashlib.sha256(text.encode()).digest())

    seen, out = set(), []
    for r in sorted(rows, key=key):
        role, text = (" " if v is None else v for v in r[2:4])
        bare = text.strip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    """The cheapest of all edits with at most three insertions in a row, the least letters among equals."""
    marked, best = faults_of(rows), None

    def go(k, state, cost, letters, turns, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(marked) and state in ("", "a"):
            best = min(best or (cost, letters, turns), (cost, letters, turns))
        if inserted < 3:
            role, after = OTHER[state]
            go(k, after, cost + 3, letters + "I", [*turns, f"{role}:"], inserted + 1)
        if k < len(marked):
            role, text, fault = marked[k]
            go(k + 1, state, cost + 4, letters + "D", turns, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == OTHER[state][1] or (role[:1] == "s" and state == ""):
                    go(k + 1, role[:1], cost + more, letters + "K", [*turns, f"{role}:{text}"], 0)
                other, after = OTHER[state]
                go(k + 1, after, cost + 3 + more, letters + "R", [*turns, f"{other}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    initials = [r[:1] for r, _, _ in marked]
    turns = {r[1] for r in rows if r[1] is not None}
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **{f: sum(x == f for _, _, x in marked) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": best[0], "audit": best[1], "turns": len(best[2]), "digest": hashlib.sha256("\n".join(best[2]).encode()).hexdigest()}


def repaired(df):
    return {r.conversation: {k: v for k, v in r.asDict().items() if k != "conversation"}
            for r in C.repairs(df, stored(C.plans(df), "plans")).collect()}


def test_against_all_edits(spark, folder):  # noqa: F811
    lot, rows = random.Random(4), []
    for conv in range(160):
        for k in range(lot.randrange(1, 6)):
            rows.append((conv, lot.choice([None, k, k, k, k + 1, 9]), lot.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         lot.choice(["a.", "b!", "c", "d?", "", " \t", None, "e. ", "f.\n\x0b", "ü。"])))
    want = {c: brute([r for r in rows if r[0] == c]) for c in range(160)}
    assert repaired(spark.createDataFrame(rows, ROWS).repartition(7)) == want


def test_odd_tables(spark, folder):  # noqa: F811
    rows = [(None, None, None, None), (None, 2, "user", "q?"), (2**60 + 1, 0, "user", "x" * 300_000 + "."), (2**60, 0, "user", "é."),
            (5, -(2**63), "user", "a."), (5, 2**63 - 1, "assistant", "b.")]
    df = spark.createDataFrame(rows * 2, ROWS).select("*", *[F.lit(1).alias(c) for c in ("key", "timed", "part", "edits", "digest", "Place")])
    found = repaired(df)
    for name in (None, 2**60, 2**60 + 1):
        assert found[name] == brute([r for r in rows * 2 if r[0] == name])
    assert found[5]["gaps"] == 2**63 - 1 and found[5]["audit"] == "KDKD"
    assert repaired(df.where("false")) == {}


def test_turns_are_whole(spark, folder):  # noqa: F811
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", "c"), (1, 3, "user", "b.")]
    df = spark.createDataFrame(rows, ROWS)
    found = [(r.place, r.edit, r.role, r.text) for r in C.repaired_turns(df, stored(C.plans(df), "plans")).orderBy("place").collect()]
    want = brute(rows)
    assert "".join(e for _, e, _, _ in found) == want["audit"].replace("D", "")
    assert hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in found).encode()).hexdigest() == want["digest"]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    monkeypatch.setattr(C, "IN_MEMORY", 16)


def streamed(rows, batch):
    """The two streams over one conversation in this process, in batches of a few rows."""
    marked = faults_of(rows)
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    narrow = pd.DataFrame([("c", r[1] is not None, r[1] or 0, m[0][:1], m[2] == "blank", m[2] == "duplicate", m[2] == "truncated")
                           for r, m in zip(ordered, marked, strict=True)][::-1],
                          columns=["key", "timed", "turn", "initial", "blank", "duplicate", "truncated"])
    plan = pd.concat(C._plan(narrow[k:k + batch] for k in range(0, len(narrow), batch)))
    report = dict.fromkeys(C.REPORT, 0)
    said = pd.DataFrame([{"key": "c", "timed": r[1] is not None, "turn": r[1] or 0, "part": 0, "edits": None, "role": m[0], "text": m[1], **report}
                         for r, m in zip(ordered, marked, strict=True)])
    both = pd.concat([plan.assign(role="", text=""), said])
    both["last"] = both.edits.isna()
    both = both.astype({"edits": object}).sort_values(["timed", "turn", "last", "part"], kind="stable")
    both["edits"] = [e if isinstance(e, str) else None for e in both.edits]
    out = pd.concat(C._turns((both[k:k + batch] for k in range(0, len(both), batch)), False))
    return len(plan), out.iloc[0].drop("key").to_dict()


def test_blocks_and_spill(small_blocks):
    lot = random.Random(8)
    for _ in range(60):
        rows = [(1, lot.choice([None, None, k]), lot.choice(["user", "assistant", "system"]), lot.choice(["a.", "b", "", f"{k}."])) for k in range(7)]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        parts, found = streamed(rows, lot.randrange(1, 5))
        assert parts == 3 and found == brute(rows)


def test_giant_conversation(spark, folder):  # noqa: F811
    """More rows than a block: the pattern holds, and the cost is that of a plain search for the cost alone."""
    n = 70_000
    df = spark.range(n).select(F.lit(3).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.xxhash64("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.col("id").cast("string"), F.when(F.xxhash64("id") % 5 == 0, "").otherwise(".")).alias("text"))
    rows = sorted((r.turn, r.role, r.text) for r in df.collect())
    costs = {"": 0, "u": 10**9, "a": 10**9}
    for _, role, text in rows:
        more = 0 if text.endswith(".") else 3
        after = {s: c + 4 for s, c in costs.items()}
        for state, c in costs.items():
            for step in range(3):
                other = OTHER[state][1]
                after[other] = min(after[other], c + 3 * step + more + (0 if role[0] == other else 3))
                state = other
        costs = after
    planned = stored(C.plans(df), "plans")
    assert planned.count() == 3
    found = C.repairs(df, planned).first()
    assert found.cost == min(costs[""], costs["a"], costs["u"] + 3) and len(found.audit.replace("I", "")) == n
    turns = C.repaired_turns(df, planned).orderBy("place").collect()
    assert [t.place for t in turns] == list(range(found.turns)) and re.fullmatch("s?(ua)+", "".join(t.role[0] for t in turns))
