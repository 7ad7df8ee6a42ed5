"""Running sums and previous values over raw rows against plain windows, with a
third of all rows on one key."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tally.operators.ids import numbered
from tally.operators.scan import running_in_order


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    data = []
    for i in range(2400):
        key = 0 if rnd.random() < 0.34 else rnd.choice([None, *range(1, 40)])
        data.append((key, rnd.choice([None, *range(30)]), i, rnd.choice([None, -5, 1, 7, 2 ** 40])))
    data += [(99, 5, 9999, None), (98, 1, 9998, None), (98, 2, 9997, None)]
    return spark.createDataFrame(data, "k int, d int, id int, v long").repartition(6)


@pytest.mark.parametrize("bucket", [1, 7, 50, 10_000])
@pytest.mark.parametrize("unique", [True, False])
def test_rows_frame_and_previous_value(events, bucket, unique):
    got = running_in_order(events, "k", ["d", "id"], {"s": "v", "ids": "id"}, {"p": "v", "pid": "id"},
                           unique=unique, rows_per_bucket=bucket)
    w = Window.partitionBy("k").orderBy("d", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = events.select("*", F.sum("v").over(upto).alias("s"), F.sum("id").over(upto).alias("ids"),
                         F.lag("v").over(w).alias("p"), F.lag("id").over(w).alias("pid"))
    assert got.columns == want.columns and rows(got) == rows(want)


@pytest.mark.parametrize("bucket", [1, 13, 10_000])
def test_range_frame_counts_peers_together(events, bucket):
    got = running_in_order(events, ["k"], "d", {"s": "v", "twice": "v", "ids": "id"}, frame="range", rows_per_bucket=bucket)
    w = Window.partitionBy("k").orderBy("d")
    want = events.select("*", F.sum("v").over(w).alias("s"), F.sum("v").over(w).alias("twice"),
                         F.sum("id").over(w).alias("ids"))
    assert got.columns == want.columns and rows(got) == rows(want)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, 5)] * 20 + [(2, 1, 1)] * 3, "k int, d int, v long")
    got = running_in_order(df, "k", "d", {"s": "v"}, {"p": "v"}, rows_per_bucket=4)
    assert sorted(r["s"] for r in got.where("k = 1").collect()) == [5 * i for i in range(1, 21)]
    assert rows(got.where("k = 2"), "s", "p") == [(1, None), (2, 1), (3, 1)]
    assert running_in_order(df.where("false"), "k", "d", {"s": "v"}, {"p": "v"}).collect() == []
    assert running_in_order(df.where("false"), "k", "d", {"s": "v"}, frame="range").collect() == []
    with pytest.raises(ValueError):
        running_in_order(df, "k", "d", {}, {"p": "v"}, frame="range")


def test_no_window_holds_more_than_a_bucket(spark, events):
    """Two thirds of the rows on one key: windows are over (bucket, key), and a
    bucket never has more rows than asked for."""
    hot = events.unionByName(events.withColumn("k", F.lit(0)).withColumn("id", F.col("id") + 100_000))
    numbers, n = numbered(hot, ["k", "d", "id"], "rid", unique=True)
    assert n == hot.count()
    per = numbers.groupBy(((F.col("rid") - 1) / 100).cast("int").alias("b")).count().agg(F.max("count")).first()[0]
    assert per == 100
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = running_in_order(hot, "k", ["d", "id"], {"s": "v"}, unique=True,
                                rows_per_bucket=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    over = re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", plan)
    raw = [w for w in over if "_rid" in w]
    assert raw and all(w.startswith("_b#") for w in raw)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_unique_ids_are_dense_and_in_order(events, parts):
    got, n = numbered(events, ["k", "d", "id"], "rid", num_partitions=parts, unique=True)
    found = [tuple(r) for r in got.orderBy("rid").select("rid", "id").collect()]
    want = [r["id"] for r in events.orderBy("k", "d", "id").collect()]
    assert found == list(enumerate(want, 1)) and n == len(want)
