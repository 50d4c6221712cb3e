from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightloom.functions import casting as C
from freightloom.functions.flags import flag, score, usable
from freightloom.functions.geo import haversine_km, leg_type


def values(spark, texts, make):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_safe_cast_and_blanks(spark):
    texts = ["1.5", "", " ", "abc", None, " 2 "]
    assert values(spark, texts, lambda c: C.safe_cast(C.blank_to_null(c), "double")) == [1.5, None, None, None, None, 2.0]
    assert values(spark, ["", " ", "a"], lambda c: C.blank_to_null(c, trim=False)) == [None, " ", "a"]
    shapes = ["12.5d", "3f", "0x1p3", "1e3", ".5", "5.", "-1.5E-1", "1.2.3", "\t7\n", "inf"]
    assert values(spark, shapes, lambda c: C.safe_cast(c, "double")) == [
        None, None, None, 1000.0, 0.5, 5.0, -0.15, None, 7.0, math.inf]
    assert values(spark, ["1.2d", "1e1", "inf"], lambda c: C.safe_cast(c, C.NUMERIC)) == [None, Decimal(10), None]
    spaces = ["\tA\r\n", "\u00a0 B\u2003", "a b", "\u3000", "\x85C\x0b"]
    assert values(spark, spaces, C.trim_all) == ["A", "B", "a b", "", "C"]
    assert values(spark, ["\u00a0\t"], C.blank_to_null) == [None]
    assert values(spark, ["3", "3.7", "x"], lambda c: C.safe_cast(c, "bigint"))[::2] == [3, None]
    assert values(spark, ["1.1234567895"], lambda c: C.safe_cast(c, C.NUMERIC)) == [Decimal("1.123456790")]


def test_datetimes(spark):
    texts = ["2025-07-01 10:00:00", "2025-07-01T10:00:00", "01/07/2025 10:00:00", "2025-07-01", "2025", "2025-07",
             "31/02/2025 10:00:00", "soon", "", None, "2025-07-01 10:00:00\n"]
    ten, midnight = dt.datetime(2025, 7, 1, 10), dt.datetime(2025, 7, 1)
    assert values(spark, texts, C.parse_datetime) == [ten, ten, ten, midnight] + [None] * 7


def test_datetimes_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist in New York on this day
        assert values(spark, ["09/03/2025 02:30:00"], C.parse_datetime) == [dt.datetime(2025, 3, 9, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates(spark):
    texts = ["2025-07-01", "01/07/2025", "1/7/2025", "2025", "2025-13-01", "n/a", None]
    day = dt.date(2025, 7, 1)
    assert values(spark, texts, C.parse_date) == [day, day, day, None, None, None, None]


def test_booleans(spark):
    assert values(spark, [" Yes", "TRUE", "1", "no", "False", "0 ", "maybe", "", None], C.parse_bool) == [
        True, True, True, False, False, False, None, None, None]


def test_enum_correction_keeps_null(spark):
    make = lambda c: C.correct_enum(c, ("a", "b"), F.lit("fixed"))
    assert values(spark, ["a", "x", "", None], make) == ["a", "fixed", "fixed", None]


def test_stable_round_is_half_away_from_zero(spark):
    make = lambda c: C.stable_round(c.cast("double"), 2)
    assert values(spark, ["2.345", "-2.345", "0.285", "1.005", None], make) == [2.35, -2.35, 0.29, 1.01, None]


def test_first_rule_wins_and_null_does_not_hold(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    out = df.select(flag([(F.col("x") > 0, "positive"), (F.col("x") > 3, "large")]).alias("f"))
    assert [r.f for r in out.collect()] == ["positive", "positive", "ok"]


def test_score_and_usable(spark):
    df = spark.createDataFrame(
        [("ok", "ok"), ("corrected", "ok"), ("bad", "bad"), ("ok", "bad")], "a string, b string")
    out = df.withColumn("quality_record", score({"a": ("ok", "corrected")}, ["b"]))
    assert [r.quality_record for r in out.collect()] == ["clean", "clean", "critical", "warning"]
    unscored = spark.createDataFrame([("clean",), (None,), ("critical",)], "quality_record string")
    assert usable(unscored).count() == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-89, 89), st.floats(-179, 179)] * 2), min_size=1, max_size=20))
def test_haversine_against_atan2(spark, points):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double, c double, d double")
    got = [r[1] for r in df.select("i", haversine_km(*map(F.col, "abcd"), places=None)).orderBy("i").collect()]
    for (a, b, c, d), km in zip(points, got, strict=True):
        p, q = math.radians(a), math.radians(c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
        assert abs(km - 12742 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))) < 1e-3


def test_haversine_null_and_antipodes(spark):
    df = spark.createDataFrame([(None, 0.0), (0.0, 180.0)], "a double, b double")
    got = [r[0] for r in df.select(haversine_km(F.col("a"), F.lit(0.0), F.lit(0.0), F.col("b"))).collect()]
    assert got == [None, 20015.09]


def test_leg_type(spark):
    df = spark.createDataFrame([("ON_A", "DN_A"), ("ON_A", "CH_A"), ("CH_A", "DN_A"), ("DN_A", "ON_A"), ("ONXA", "DN_A")],
                               "o string, d string")
    assert [r[0] for r in df.select(leg_type(F.col("o"), F.col("d"))).collect()] == [
        "direct", "indirect_leg1", "indirect_leg2", "unknown", "unknown"]
