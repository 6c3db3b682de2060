import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import dicts
from tidemark.functions import keys, labels, numeric, parse


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x")).alias("y")).first()[0]


def test_words_for_no_value(spark):
    rows = [("  Not Available ",), ("NA",), ("na",), ("",), ("--",), (" x ",), (None,), ("\tNA",)]
    got = [r.y for r in spark.createDataFrame(rows, "x string").select(parse.text_or_null("x").alias("y")).collect()]
    assert got == [None, None, "na", None, None, "x", None, "\tNA"]


def test_audit_columns_are_left_alone(spark):
    df = spark.createDataFrame([(" NA ", " NA ", 1)], "a string, _b string, n int")
    assert dicts(parse.clean_text_columns(df)) == [{"a": None, "_b": " NA ", "n": 1}]


def test_numbers(spark):
    assert one(spark, "1,204", parse.to_double) == 1204.0
    assert one(spark, "12..4", parse.to_double) is None
    assert one(spark, "3.7", parse.to_int) == 3
    assert one(spark, "-3.7", parse.to_int) == -3
    assert one(spark, "1e12", parse.to_int) is None
    assert one(spark, "1d", parse.to_double) == 1.0
    assert one(spark, "1d", lambda c: parse.to_double(c, strict=True)) is None
    assert one(spark, "NaN", lambda c: parse.to_int(c, strict=True)) is None
    assert one(spark, " 1,000.5", lambda c: parse.to_double(c, strict=True)) == 1000.5


def test_dates(spark):
    assert one(spark, "06/30/2025", parse.to_day) == dt.date(2025, 6, 30)
    assert one(spark, "not a date", parse.to_day) is None
    assert one(spark, "02/30/2022", parse.to_day) is None
    assert one(spark, "7/1/2022", parse.to_day) is None


def test_flags_zip_and_title(spark):
    assert [one(spark, w, parse.to_flag) for w in ("yes", "N", "maybe", None)] == [True, False, None, None]
    assert one(spark, None, parse.to_flag_or_false) is False
    assert [one(spark, z, parse.to_zip5) for z in ("958", "95814-1234", "1234567", "none", None)] == \
        ["00958", "95814", "12345", "00000", None]
    assert one(spark, "O'NEIL OAK-RIDGE", parse.title_case) == "O'neil Oak-ridge"


def test_every_comparison_phrase(spark):
    expected = {
        "Better Than the National Rate": "better", "Fewer Days Than Average per 100 Discharges": "better",
        "Worse Than the National Rate": "worse", "More Days Than Average per 100 Discharges": "worse",
        "No Different Than the National Rate": "no_different", "Average Days per 100 Discharges": "no_different",
        "Number of Cases Too Small": "too_few_cases", "something else": "not_available", None: "not_available"}
    for phrase, category in expected.items():
        assert one(spark, phrase, labels.comparison_category) == category


def test_ownership_groups(spark):
    expected = {"Voluntary non-profit - Church": "Non-profit", "Proprietary": "For-profit", "Government - State": "Government",
                "Tribal": "Government", "Physician": "Physician-owned", "Unknown": "Other", None: "Other"}
    for owner, group in expected.items():
        assert one(spark, owner, labels.ownership_group) == group


def test_display_text(spark):
    df = spark.createDataFrame([(3, 2), (0, -1), (None, 0), (5, None)], "s int, d int")
    got = df.select(labels.star_glyphs(F.col("s")), labels.change_text(F.col("d")), labels.rating_label(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("★★★☆☆", "▲ 2", "3 ★"), ("☆☆☆☆☆", "▼ 1", "0 ★"), ("—", "", "Not rated"), ("★★★★★", "", "5 ★")]


def test_tier_bounds_are_inclusive(spark):
    values = [None, 70.0, 69.9, 55.0, 45.0, 30.0, 29.9]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "c double").select(labels.outcome_tier(F.col("c"))).collect()]
    assert got == ["Insufficient data", "High performer", "Above average", "Above average", "Average", "Below average", "Low performer"]


def test_rounding_is_on_the_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (2.5,), (-2.125,), (None,)], "x double")
    assert [r[0] for r in df.select(numeric.round_half_away(F.col("x"), 2)).collect()] == [1.0, 2.68, 2.5, -2.13, None]
    assert df.select(F.round("x", 2)).first()[0] == 1.01


def test_ratio_without_whole_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(numeric.percent(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


def test_hash_of_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    joined = {r[0] for r in df.select(keys.attribute_hash(["x", "y"], guard_nulls=False)).collect()}
    guarded = {r[0] for r in df.select(keys.attribute_hash(["x", "y"])).collect()}
    assert len(joined) == 1 and len(guarded) == 2


def test_fingerprint_ignores_order_and_sees_copies(spark):
    rows = [(i, str(i % 3), None if i % 4 else "x") for i in range(50)]
    base = keys.fingerprint(spark.createDataFrame(rows, "a int, b string, c string")).first()
    turned = keys.fingerprint(spark.createDataFrame(rows[::-1], "a int, b string, c string").repartition(7)).first()
    copied = keys.fingerprint(spark.createDataFrame(rows + rows[:1], "a int, b string, c string")).first()
    twice = keys.fingerprint(spark.createDataFrame(rows + rows[:1] * 2, "a int, b string, c string")).first()
    assert base == turned
    assert len({base.content_sum, copied.content_sum, twice.content_sum}) == 3


@settings(max_examples=10, deadline=None)
@given(st.lists(st.decimals(min_value=-1000, max_value=1000, places=1), min_size=1, max_size=30))
def test_mean_is_independent_of_order(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    a = df.agg(numeric.exact_mean(F.col("x"), 1)).first()[0]
    b = df.orderBy(F.desc("x")).repartition(3).agg(numeric.exact_mean(F.col("x"), 1)).first()[0]
    assert a == b == float(sum(values)) / len(values)
