import datetime as dt
import math
import random
from bisect import bisect_left, bisect_right
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import dicts
from bindings import feeds, tables
from tidemark.operators import history, newest, ranks, routing, shape, tests
from tidemark.plans.model_tests import ModelTest, run_model_tests
from tidemark.session import WIDE_ROWS, shuffles_for, with_settings


def test_route_names_every_broken_rule(spark):
    df = spark.createDataFrame([("12AB", "CA"), ("050003", "ZZ"), (None, "ZZ"), ("050001", "CA")], "facility_id string, state string")
    routed = routing.route(df, routing.key_rules())
    assert [r.facility_id for r in routed.good.collect()] == ["050001"]
    assert {r.facility_id: r._reject_reason for r in routed.bad.collect()} == {
        "12AB": "invalid_facility_id", "050003": "invalid_state", None: "invalid_facility_id;invalid_state"}


def test_newest_row_wins(spark):
    t = dt.datetime
    df = spark.createDataFrame([("1", "old", t(2026, 1, 1)), ("1", "new", t(2026, 2, 1)), ("2", "only", t(2026, 1, 1))],
                               "id string, v string, at timestamp")
    assert {r.id: r.v for r in newest.newest_per_key(df, ["id"], [F.desc("at")]).collect()} == {"1": "new", "2": "only"}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_ties_do_not_depend_on_layout(spark, parts):
    rng = random.Random(7)
    rows = [(k, rng.choice("abc"), rng.randint(0, 3), 5) for k in range(20) for _ in range(rng.randint(1, 30))]
    expected = {}
    for k, a, b, _ in rows:
        expected[k] = min(expected.get(k, (a, b)), (a, b))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + rows, "k int, a string, b int, at int").repartition(parts)
    got = {r.k: (r.a, r.b) for r in newest.newest_per_key(df, ["k"], [F.desc("at")]).collect()}
    assert got == expected


def test_one_key_with_most_rows_is_cut_before_the_shuffle(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v"))
    found = newest.newest_per_key(df, ["k"], [F.desc("v")])
    assert found.where("k = -1").first().v == 29999 and found.count() == 10001
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def brute_counts(rows):
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    result = {}
    order = lambda v: (1, 0.0) if math.isnan(v) else (0, v)
    for g, vs in groups.items():
        for v in vs:
            below = sum(order(w) < order(v) for w in vs)
            same = sum(order(w) == order(v) for w in vs)
            result[(g, repr(v))] = (same, below, len(vs))
    return result


@pytest.mark.parametrize("pieces", [1, 40])
def test_ordered_counts_by_brute_force(spark, pieces):
    rng = random.Random(3)
    rows = [("hot", 0.0)] * 400 + [("hot", 100 + rng.random() / 1000) for _ in range(300)]
    rows += [("hot", v) for v in (1e300, -1e300, float("inf"), float("-inf"), float("nan"), 5e-324, -7.5)]
    rows += [("small", float(rng.randint(-5, 5))) for _ in range(60)] + [(None, 1.0), (None, 2.0), ("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {(r.g, repr(r.v)): (r.n_eq, r.n_lt, r.n_total) for r in ranks.ordered_counts(df, ["g"], "v", pieces).collect()}
    assert got == brute_counts(rows)


@pytest.mark.parametrize("values", [
    lambda rng: rng.random() / 1e7 + (0.01 if rng.random() < 0.0001 else 0),       # a narrow band and outliers
    lambda rng: rng.choice([1.0, 2.0, 3.0]) if rng.random() < 0.8 else rng.random(),  # heavy ties
    lambda rng: rng.lognormvariate(0, 9),
])
def test_no_piece_holds_much_more_than_its_share(spark, values):
    """Nine tenths of the rows are one group; the largest piece stays within four times the mean."""
    rng = random.Random(2)
    rows = [("hot" if i % 10 else f"g{i % 70}", values(rng)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = ranks.value_pieces(df, ["g"], "v", 20)
    sizes = [r["count"] for r in found.groupBy("_piece").count().collect()]
    assert max(sizes) <= 4 * found.count() / 20
    hot = sorted(v for g, v in rows if g == "hot")
    for r in ranks.ordered_counts(df, ["g"], "v", 20).where("g = 'hot'").collect():
        assert (r.n_lt, r.n_lt + r.n_eq, r.n_total) == (bisect_left(hot, r.v), bisect_right(hot, r.v), len(hot))


def test_quantiles_and_ranks_equal_the_built_in_forms(spark):
    rng = random.Random(11)
    rows = [(i % 5, round(rng.lognormvariate(1, 2), 1)) for i in range(3000)] + [(9, 3.5)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p90": 0.9}
    got = {r.g: r for r in ranks.group_quantiles(df, ["g"], "v", probs).collect()}
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in probs.items()]).collect()
    for r in want:
        for name in probs:
            assert got[r.g][name] == pytest.approx(r[name], rel=1e-12), (r.g, name)
    window = df.withColumn("pr", F.percent_rank().over(Window.partitionBy("g").orderBy("v"))).distinct()
    counts = ranks.ordered_counts(df, ["g"], "v", 50).select("g", "v", ranks.percent_rank_from_counts().alias("pr"))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, window.collect()))


def test_few_values_give_the_same_counts(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice("ab"), rng.randint(0, 9) / 10) for _ in range(500)], "g string, v double")
    assert sorted(map(tuple, ranks.ordered_counts_few_values(df, ["g"], "v").collect())) == \
        sorted(map(tuple, ranks.ordered_counts(df, ["g"], "v").collect()))


@pytest.mark.parametrize("few", [False, True])
def test_descending_rank_leaves_gaps_and_nulls(spark, few):
    df = spark.createDataFrame([(1, "a", 9.0), (2, "a", 9.0), (3, "a", 5.0), (4, "a", None), (5, "b", 1.0)], "id int, g string, v double")
    got = {r.id: r.place for r in ranks.descending_rank(df, ["g"], "v", "place", ["id"], few).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: None, 5: 1}


def test_attach_by_value_keeps_rows_without_a_key(spark):
    df = spark.range(2000).select("id", F.lit("g").alias("g"), (F.col("id") % 7).cast("double").alias("v"), (F.col("id") % 2 == 0).alias("ok"))
    lookup = spark.createDataFrame([("g", float(i), i * 10) for i in range(7)], "g string, v double, x int")
    got = ranks.attach_by_value(df, lookup, ["g"], "v", F.col("ok"), ["id"])
    assert got.count() == 2000
    assert got.where("ok and x = v * 10").count() == 1000 and got.where("not ok and x is null").count() == 1000


def versions_of(spark, rows):
    df = spark.createDataFrame(rows, "k string, rel string, a int").withColumn("rel", F.col("rel").cast("date"))
    found = history.versions(df, "k", "rel", F.md5(F.coalesce(F.col("a").cast("string"), F.lit("NA"))), ["a"])
    return sorted((r.k, r.a if r.a is not None else -1, str(r.valid_from), str(r.valid_to), r.is_current) for r in found.collect())


def test_history_golden(spark):
    rows = [("A", "2026-01-01", 3), ("A", "2026-04-01", 3), ("A", "2026-07-01", 4), ("B", "2026-01-01", 5)]
    assert versions_of(spark, rows) == [
        ("A", 3, "2026-01-01", "2026-07-01", False), ("A", 4, "2026-07-01", "None", True),
        ("B", 5, "2026-01-01", "2026-04-01", False)]


def test_key_that_leaves_and_returns(spark):
    rows = [("A", "2026-01-01", 3), ("Z", "2026-04-01", 1), ("A", "2026-07-01", 3), ("A", "2026-10-01", None), ("Z", "2026-10-01", 1)]
    assert versions_of(spark, rows) == [
        ("A", -1, "2026-10-01", "None", True), ("A", 3, "2026-01-01", "2026-10-01", False),
        ("Z", 1, "2026-04-01", "None", True)]


def test_tiling_faults(spark):
    df = spark.createDataFrame([("a", "2026-01-01", "2026-02-01"), ("a", "2026-03-01", None), ("b", "2026-01-01", "2026-01-01"),
                                ("c", "2026-01-01", "2026-02-01"), ("c", "2026-02-01", None)], "k string, valid_from string, valid_to string")
    assert sorted(r.k for r in tests.tiling_faults(df, "k").collect()) == ["a", "b"]


def test_previous_value_skips_nulls(spark):
    df = spark.createDataFrame([("x", 1, 4), ("x", 2, None), ("y", 1, None), ("x", 1, 3)], "k string, r int, v int")
    got = df.groupBy("k").agg(newest.value_at_newest("v", F.col("r")).alias("v"))
    assert {r.k: r.v for r in got.collect()} == {"x": 4, "y": None}


def test_histogram_counts_everything_once(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(81)] + [("b", 2.0)] * 3, "g string, v double")
    got = dicts(shape.equal_width_histogram(df, ["g"], "v", 40))
    assert sum(r["n"] for r in got if r["g"] == "a") == 81 and max(r["bin"] for r in got) == 40
    assert [r["n"] for r in got if r["g"] == "b"] == [3]


def test_sets(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "r int")
    b = spark.createDataFrame([(2,)], "r int")
    assert [r.r for r in shape.not_yet_done(a, b, ["r"]).collect()] == [1]
    assert sorted(r.r for r in shape.not_yet_done(a, b, ["r"], everything=True).collect()) == [1, 2]
    both = shape.conformed_union({"a": a, "b": b.withColumn("x", F.lit("q"))}, "feed")
    assert both.count() == 4 and both.where("x is null").count() == 3
    empty = spark.createDataFrame([], "r date")
    assert shape.newer_than_loaded(a.select(F.lit("2026-01-01").cast("date").alias("r")), empty, "r").count() == 3


def test_table_tests(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (None, 200.0), (None, -1.0)], "k int, v double")
    parent = spark.createDataFrame([(2,), (None,)], "k int")
    assert [tuple(r) for r in tests.repeated_values(df, "k").collect()] == [(1, 2)]
    assert tests.null_rows(df, "k").count() == 2
    assert tests.out_of_range(df, "v", 0, 100).count() == 2 and tests.out_of_range(df, "v", low=0).count() == 1
    assert tests.orphan_rows(df, "k", parent, "k").count() == 2
    assert tests.unexpected_values(df, "k", [2]).count() == 2
    grades = spark.createDataFrame([(0,), (1,), (1001,)], "n int").select(tests.graded(F.col("n"), 0, 1000).alias("g"))
    assert [r.g for r in grades.collect()] == ["pass", "warn", "error"]


def test_latest_per_feed(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "feed string, r int")
    assert sorted(map(tuple, newest.latest_slice(df, "r").collect())) == [("a", 2)]
    assert sorted(map(tuple, newest.latest_slice_per_feed(df, "feed", "r").select("feed", "r").collect())) == [("a", 2), ("b", 1)]


def test_orphans_are_counted_by_key_before_they_move(spark):
    child = spark.createDataFrame([(k,) for k in ["a", "a", "b", "b", "b", None, "c"]], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert {tuple(r) for r in tests.orphan_counts(child, "k", parent, "id").collect()} == {("b", 3), ("c", 1)}
    declared = ModelTest("child", "relationship", ("k",), parent=("parent", "id"), error_above=3)
    some = run_model_tests(spark, {"child": child, "parent": parent}, [declared]).first()
    none = run_model_tests(spark, {"child": child.where("k = 'a'"), "parent": parent}, [declared]).first()
    assert (some.offending, some.grade) == (4, "error") and (none.offending, none.grade) == (0, "pass")


def test_tables_of_the_chain_are_stored_without_a_shuffle(spark, tmp_path):
    """Tasks write what they hold, so a file comes from each of them."""
    from bindings.tables import Chain

    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "if(id % 2 = 0, '2025-01-01', '2025-02-01') as release_date")
    made = Chain(spark, str(tmp_path))
    out = made._stored("some", lambda: rows, by_release=True)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
    assert len(out.inputFiles()) == 8       # two releases in each of four tasks; a shuffle for the folders left two files


def test_settings_hold_for_a_block_only(spark):
    key, other = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(other, "3m")
    before = {k: spark.conf.get(k, None) for k in (key, other)}
    with pytest.raises(ZeroDivisionError), with_settings(spark, {key: "7", other: "5m"}):
        assert (spark.conf.get(key), spark.conf.get(other)) == ("7", "5m")
        1 / 0
    assert {k: spark.conf.get(k, None) for k in (key, other)} == before
    spark.conf.unset(other)


def test_stored_tables_are_read_in_small_pieces_and_written_without_a_sort(spark, monkeypatch):
    """A file of a feed has few rows, all of the rows are there, and rows go to the folders of their releases as they come."""
    rows = spark.range(1000).selectExpr("id", "cast(1990 + id % 5 as string) as release_date").coalesce(1)
    monkeypatch.setattr(tables, "FEED_ROWS", 100)
    monkeypatch.setattr(feeds, "bronze", lambda *a: rows)
    chain, held = tables.Chain(spark, "none"), []
    monkeypatch.setattr(tables, "with_settings", lambda spark_, settings: held.append(settings) or with_settings(spark_, settings))
    landed = chain.bronze("any")
    assert sorted(r.id for r in landed.collect()) == list(range(1000)) and held == [WIDE_ROWS]
    assert max(r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()) <= 100
    stored = chain._stored("by", lambda: rows, by_release=True)
    assert stored.columns == rows.columns and {(r.id, r.release_date) for r in stored.collect()} == {(k, str(1990 + k % 5)) for k in range(1000)}
    order = [r.id for r in spark.read.parquet(f"{chain.folder}/by/release_date=1990").collect()]
    assert order == list(range(0, 1000, 5))


def test_shuffles_of_stored_tables_are_dealt_by_the_rows_of_their_feeds(spark, monkeypatch):
    """However few shuffle partitions the session has, a task sorts few rows: a session's fixed number came to spill at size."""
    rows = spark.range(4000).selectExpr("id", "id % 1000 as key", "'2025-01-01' as release_date")
    monkeypatch.setattr(tables, "FEED_ROWS", 100)
    monkeypatch.setattr(feeds, "bronze", lambda *a: rows)
    chain, key = tables.Chain(spark, "none"), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        stored = chain._stored("dealt", lambda: rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), of=("any",))
        assert sorted(map(tuple, stored.collect())) == [(k, 4) for k in range(1000)]
        assert len(stored.inputFiles()) == 40 and spark.conf.get("spark.sql.shuffle.partitions") == "4"
        assert shuffles_for(spark, 300, 100) == {"spark.sql.shuffle.partitions": "4"}     # a session's larger number holds
    finally:
        spark.conf.set(key, before)
