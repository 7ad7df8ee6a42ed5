"""Skew-safe operators against their plain single-window definitions.

The data has one hot key holding about a third of all rows and many ties
per day, the case the two-level operators are built for.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tally.operators import (first_per, next_in_order, percentiles, rank_top,
                             rank_within, with_dense_id)


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = 0 if rnd.random() < 0.34 else rnd.randint(1, 60)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        data.append((key, day, i, rnd.choice(["a", "b", "c", "d", None])))
    return spark.createDataFrame(data, "k int, d date, id int, v string").repartition(6)


def test_next_in_order_equals_lead(events):
    got = next_in_order(events, "k", ["d", "id"], ["v"], prefix="n_", rows_per_bucket=50)
    w = Window.partitionBy("k").orderBy("d", "id")
    want = events.withColumn("n_v", F.lead("v").over(w))
    assert rows(got, "id", "n_v") == rows(want, "id", "n_v")


def test_rank_within_equals_rank(events):
    got = rank_within(events, ["k"], "d", "r")
    want = events.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("d")))
    assert rows(got, "id", "r") == rows(want, "id", "r")


def test_first_and_last_per(events):
    w = Window.partitionBy("k").orderBy("d", "id")
    first = events.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    assert rows(first_per(events, "k", ["d", "id"], ["v", "id"]), "k", "id") == rows(first, "k", "id")
    wl = Window.partitionBy("k").orderBy(F.col("d").desc(), F.col("id").desc())
    last = events.withColumn("rn", F.row_number().over(wl)).where("rn = 1")
    got = first_per(events, "k", ["d", "id"], ["id"], last=True)
    assert rows(got, "k", "id") == rows(last, "k", "id")


def test_rank_top_keeps_ties(events):
    got = rank_top(events, "k", "d")
    mins = events.groupBy("k").agg(F.min("d").alias("d"))
    want = events.join(mins, ["k", "d"])
    assert rows(got, "id") == rows(want, "id")
    nulls = events.withColumn("k", F.when(F.col("k") > 2, F.col("k")))
    best = nulls.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("d").desc())))
    assert rows(rank_top(nulls, "k", "d", largest=True), "id") == rows(best.where("r = 1"), "id")


def test_rank_within_takes_null_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (1, None), (1, 2), (1, 2), (1, 3)], "k int, d int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("d")))
    assert rows(rank_within(df, "k", "d", "r")) == rows(want)


def test_dense_ids_split_a_run_of_equal_rows(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("a"),
                                     F.lit("x").alias("b")).repartition(6)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        got = with_dense_id(df, ["a"], "rid", num_partitions=8, copies_at_once=100)
        want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b")))
        assert rows(got) == rows(want)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n")).collect()]
        assert max(sizes) < 1500   # the run of 2000 equal rows is not one task
    finally:
        spark.conf.set(conf, old)


def test_with_dense_id_equals_row_number(events):
    got = with_dense_id(events, ["k", "d", "id"], "rid", num_partitions=5)
    want = events.withColumn("rid", F.row_number().over(Window.orderBy("k", "d", "id")))
    assert rows(got, "id", "rid") == rows(want, "id", "rid")
    ids = [r.rid for r in got.select("rid").collect()]
    assert sorted(ids) == list(range(1, events.count() + 1))


def test_with_dense_id_with_merged_ranges(spark, events):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")   # AQE merges the small ranges
    try:
        got = with_dense_id(events, ["d", "k", "id"], "rid")
        want = events.withColumn("rid", F.row_number().over(Window.orderBy("d", "k", "id")))
        assert rows(got, "id", "rid") == rows(want, "id", "rid")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_gaps_at_least_equals_brute_force(spark, events):
    from tally.operators import gaps_at_least
    starts = events.where(F.col("id") % 3 == 0).select("k", "d")
    targets = events.where(F.col("id") % 3 == 1).select("k", "d")
    cuts = [-5, 0, 1, 7, 20]
    got = {r.cut: (int(r.pairs), int(r.gap_sum))
           for r in gaps_at_least(starts, targets, "k", "d", cuts).collect()}
    pairs = starts.alias("a").join(targets.alias("b"), "k").select(
        F.datediff(F.col("b.d"), F.col("a.d")).alias("g")).collect()
    for c in cuts:
        sel = [p.g for p in pairs if p.g >= c]
        assert got[c] == (len(sel), sum(sel))


def test_percentiles_interpolate(spark):
    df = spark.createDataFrame([("x", v) for v in (1, 2, 3, 10)], "g string, v int")
    r = percentiles(df, ["g"], "v", [0.5, 0.8], ["p50", "p80"]).first()
    assert r.p50 == 2.5 and abs(r.p80 - 5.8) < 1e-9
