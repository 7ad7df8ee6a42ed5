"""Dialect rules M1-M15 and the cleaning parsers C1-C6 (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tally.functions import cleaning as C
from tally.functions import semantics as S


def one(spark, expr, data=None, schema=None):
    df = spark.createDataFrame(data, schema) if data is not None else spark.range(1)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_m1_int_avg_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, -1), (2, -2)], "g int, v int")
    got = dict(df.groupBy("g").agg(S.int_avg("v").alias("a")).collect())
    assert got == {1: 1, 2: -1}


def test_m2_int_div_and_m9_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, 0)], "a long, b long")
    assert [r.q for r in df.select(S.int_div("a", "b").alias("q")).collect()] == [3, -3, None]


def test_m3_minutes_crossed_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 1, 1, 0, 0, 59), dt.datetime(2021, 1, 1, 0, 1, 0)),
         (dt.datetime(2021, 1, 1, 0, 0, 0), dt.datetime(2021, 1, 1, 0, 0, 59))],
        "a timestamp_ntz, b timestamp_ntz")
    assert [r.m for r in df.select(S.minutes_crossed("a", "b").alias("m")).collect()] == [1, 0]


def test_m3_days_and_month_floor(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1), dt.date(2021, 1, 5))], "a date, b date")
    assert df.select(S.days_between("a", "b")).first()[0] == 4
    df2 = spark.createDataFrame([(dt.date(2020, 2, 17),)], "d date")
    assert df2.select(S.month_floor("d")).first()[0] == dt.date(2020, 2, 1)


def test_m4_us_week(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 2), dt.date(2021, 1, 3),
            dt.date(2021, 1, 10), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.w for r in df.select(S.us_week("d").alias("w")).collect()] == [1, 1, 2, 3, 53]


def test_m5_case_insensitive(spark):
    df = spark.createDataFrame([("Restaurant Cancellation", "Cheese")], "c string, t string")
    r = df.select(S.ci_like("c", "%cancellation%").alias("a"), S.ci_eq("t", "cheese").alias("b")).first()
    assert r.a is True and r.b is True


def test_m6_trimmed_items_join_numeric_key(spark):
    df = spark.createDataFrame([("1, 2",)], "l string")
    items = df.select(F.explode(C.list_items("l")).alias("i"))
    keys = spark.createDataFrame([(2,)], "k int")
    assert items.join(keys, F.col("i").try_cast("int") == F.col("k")).count() == 1


def test_c1_c3_null_like_to_blank(spark):
    df = spark.createDataFrame([(None,), ("null",), ("",), ("1, 5",), ("NULL",), ("  ",)], "e string")
    assert [r.x for r in df.select(C.blank_null_like("e").alias("x")).collect()] == [
        "", "", "", "1, 5", "", ""]


def test_list_items_keep_empty_items_of_texts_that_are_not_blank(spark):
    df = spark.createDataFrame([("1,,4",), (" 1 , 5 ,",), ("",), ("  ",), (None,)], "l string")
    assert [r.x for r in df.select(C.list_items("l").alias("x")).collect()] == [
        ["1", "", "4"], ["1", "5", ""], [], [], None]


def test_c4_c5_take_the_whole_text_as_a_number(spark):
    texts = [".5km", "-5 km", "1,234 km", "abc12", "1e3", "13.4 KM", "12.5 minutes", "1 h 20 min", "7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(C.parse_number("t").alias("d"), C.parse_int("t").alias("i")).collect()
    assert [r.d for r in got] == [0.5, -5.0, None, None, 1000.0, 13.4, None, None, 7.0]
    assert [r.i for r in got] == [None, None, None, None, None, None, None, None, 7]


@pytest.mark.parametrize("mode,blank", [(C.REFERENCE, 0.0), (C.STRICT, None)])
def test_c4_parse_number(spark, mode, blank):
    df = spark.createDataFrame([("20km",), ("13.4 km",), ("23.4",), ("",), (None,)], "d string")
    got = [r.x for r in df.select(C.parse_number("d", mode).alias("x")).collect()]
    assert got == [20.0, 13.4, 23.4, blank, None]


@pytest.mark.parametrize("mode,blank", [(C.REFERENCE, 0), (C.STRICT, None)])
def test_c5_parse_int(spark, mode, blank):
    df = spark.createDataFrame(
        [("32 minutes",), ("15 minute",), ("20mins",), ("10minutes",), ("",)], "d string")
    got = [r.x for r in df.select(C.parse_int("d", mode).alias("x")).collect()]
    assert got == [32, 15, 20, 10, blank]


def test_c6_parse_ts(spark):
    df = spark.createDataFrame([("2021-01-01 18:05:02",), ("",), (None,), ("junk",)], "t string")
    ref = [r.x for r in df.select(C.parse_ts("t").alias("x")).collect()]
    assert ref == [dt.datetime(2021, 1, 1, 18, 5, 2), dt.datetime(1900, 1, 1), None, None]
    strict = [r.x for r in df.select(C.parse_ts("t", C.STRICT).alias("x")).collect()]
    assert strict == [dt.datetime(2021, 1, 1, 18, 5, 2), None, None, None]


def test_m8_concat_skips_null(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(S.concat_text("a", "b", "c")).first()[0] == "ac"


def test_m13_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (1234, 200), (2, 3), (1, 0)], "n long, d long")
    got = [r.x for r in df.select(S.round_ratio("n", "d", 0).alias("x")).collect()]
    assert got == [3.0, -3.0, 6.0, 1.0, None]
    got2 = [r.x for r in df.select(S.round_ratio("n", "d", 2).alias("x")).collect()]
    assert got2 == [2.5, -2.5, 6.17, 0.67, None]


def test_pct_exact(spark):
    df = spark.createDataFrame([(307, 1000), (1, 3)], "n long, d long")
    assert [r.x for r in df.select(S.pct("n", "d", 1).alias("x")).collect()] == [30.7, 33.3]


def test_year_range_is_pushed_as_date_range(spark, tmp_path):
    p = str(tmp_path / "d.parquet")
    spark.createDataFrame([(dt.date(1998, 5, 1),), (dt.date(1999, 1, 1),)], "d date").write.parquet(p)
    df = spark.read.parquet(p).where(S.year_range("d", 1998, 1998))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(d" in plan


def test_measured_sums_have_no_cap(spark):
    """Distances of 1e8 and more, infinities and NaN do not fail the query."""
    rows = [("a", 0.1, 3), ("a", 0.2, 1), ("b", 1e8, 2), ("b", 0.25, 1), ("c", 1e15, 1), ("c", 1.0, 1), ("d", 1e300, 2),
            ("e", float("inf"), 1), ("e", 1.0, 1), ("f", None, 1), ("g", float("nan"), 1), ("h", -123456789.0, 1)]
    df = spark.createDataFrame(rows, "k string, x double, n long").groupBy("k").agg(S.measured_sum("x", "n").alias("s"))
    got = dict(df.collect())
    assert got["g"] != got.pop("g")
    assert got == {"a": 0.5, "b": 2e8 + 0.25, "c": 1e15 + 1, "d": 2e300, "e": float("inf"), "f": None,
                   "h": -123456789.0}


def test_round_half_of_large_values(spark):
    df = spark.createDataFrame([(1e300,), (-1e300,), (2.0 ** 60,), (2.345,), (float("inf"),), (None,)], "x double")
    got = [r[0] for r in df.select(S.round_half("x", 2)).collect()]
    assert got == [1e300, -1e300, 2.0 ** 60, 2.35, float("inf"), None]


def test_v14_with_very_long_distances(spark):
    from tally.operators.clean import clean_deliveries
    from tally.plans import delivery as V
    orders = spark.createDataFrame([(1, 1, 1, "", "", None), (2, 2, 1, "", "", None)],
                                   "order_id int, customer_id int, pizza_id int, exclusions string, extras string, "
                                   "order_time timestamp_ntz")
    raw = spark.createDataFrame([(1, 1, None, "123456789 km", "10", None), (2, 1, None, "7.5km", "10", None)],
                                "order_id int, runner_id int, pickup_time string, distance string, duration string, "
                                "cancellation string")
    got = dict(V.avg_distance_per_customer(orders, clean_deliveries(raw)).collect())
    assert got == {1: 123456789.0, 2: 7.5}
