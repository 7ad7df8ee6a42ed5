"""Hot-key joins, band joins, null-aware anti joins and mergeable distinct counts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tally.operators.anti import bloom_filter, drop_excluded, might_contain, not_in
from tally.operators.bands import within_days
from tally.operators.distinct import count_stored, stored_ids
from tally.operators.joins import parts_by_size
from tally.operators.skew import hot_hashes, hot_join, sized_join


@pytest.fixture(scope="module")
def facts(spark):
    rnd = random.Random(1)
    data = [(rnd.choice([0, 0, 0, None, rnd.randint(1, 900)]), rnd.choice(["a", "b"]), i) for i in range(6000)]
    return spark.createDataFrame(data, "k int, t string, id int").repartition(6)


def dim(spark, hot=1):
    data = [(0, "a", f"hot{i}") for i in range(hot)] + [(0, "b", "x")] + [(i, "a", f"n{i}") for i in range(1, 500)]
    return spark.createDataFrame(data + [(None, "a", "null")], "k int, t string, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("keys", [["k"], ["k", "t"]])
def test_hot_join_equals_the_plain_join(spark, facts, how, keys):
    d = dim(spark).select(*keys, "name")
    assert hot_hashes(facts, keys)
    got, want = hot_join(facts, d, keys, how), facts.join(d, keys, how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_hot_on_both_sides_and_no_hot_key(spark, facts):
    d = dim(spark, hot=40).select("k", "name")
    assert rows(hot_join(facts, d, ["k"], share=0.05)) == rows(facts.join(d, "k"))
    cold = spark.range(1000).select(F.col("id").cast("int").alias("k"))
    assert not hot_hashes(cold, ["k"])
    assert rows(hot_join(cold, d, ["k"], "left")) == rows(cold.join(d, "k", "left"))
    assert hot_join(cold.where("false"), d, ["k"]).collect() == []
    with pytest.raises(ValueError):
        hot_join(cold, d, ["k"], "full")


def test_a_hot_key_does_not_meet_in_one_task(spark, facts):
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d, n = dim(spark).select("k", "name"), facts.count()
        most = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert most(facts.join(d, "k", "left")) > 0.6 * n
        assert most(hot_join(facts, d, ["k"], "left")) < 0.3 * n
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def most_in_a_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_a_sized_join_has_tasks_of_one_size(spark, tmp_path, no_broadcast):
    def table(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    ids = lambda n: spark.range(0, n, 1, 4).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"))
    a, b = table("a", ids(8000)), table("b", ids(8000).withColumnRenamed("v", "w"))
    a2, b2 = table("a2", ids(16000)), table("b2", ids(16000).withColumnRenamed("v", "w"))
    size = parts_by_size(a, b, 1) // 40
    assert parts_by_size(a, b, size) in range(40, 43) and parts_by_size(a2, b2, size) in range(70, 90)
    for left, right, n in ((a, b, 8000), (a2, b2, 16000)):
        got = sized_join(left, right, ["k"], size)
        assert most_in_a_task(got) < 600 and got.count() == n   # the plain join: more with every row
    assert most_in_a_task(a2.join(b2, "k")) >= 2000
    assert parts_by_size(a, b) is None and sized_join(a, b, ["k"]).count() == 8000


def test_a_sized_join_equals_the_plain_join(spark, facts, tmp_path, no_broadcast):
    facts.write.parquet(f"{tmp_path}/f")
    dim(spark, hot=3).write.parquet(f"{tmp_path}/d")
    f, d = spark.read.parquet(f"{tmp_path}/f"), spark.read.parquet(f"{tmp_path}/d").select("k", "name")
    size = parts_by_size(f, d, 1) // 24
    assert parts_by_size(f, d, size) and hot_hashes(f, ["k"])
    got, want = sized_join(f, d, ["k"], size), f.join(d, "k")
    assert got.columns == want.columns and rows(got) == rows(want)
    assert most_in_a_task(got) < 0.3 * want.count()     # the hot key is spread


def day(i):
    return dt.date(1969, 12, 1) + dt.timedelta(days=i)


@pytest.mark.parametrize("least, most", [(0, 0), (0, 6), (1, 30), (-5, 3), (-9, -2), (3, 2)])
def test_band_join_equals_comparing_all_pairs(spark, least, most):
    rnd = random.Random(2)
    a = [(rnd.choice([0, 0, 1, 2, None]), rnd.choice([None, *map(day, range(70))]), i) for i in range(300)]
    b = [(rnd.choice([0, 0, 1, 3, None]), rnd.choice([None, *map(day, range(70))]), i) for i in range(80)]
    left, right = spark.createDataFrame(a, "k int, bought date, id int"), spark.createDataFrame(b, "k int, joined date, m int")
    got = within_days(left, right, "k", "bought", "joined", least, most)
    want = sorted(((k, d, i, e, j, (e - d).days) for k, d, i in a for k2, e, j in b
                   if k is not None and k == k2 and d and e and least <= (e - d).days <= most), key=repr)
    assert rows(got, "k", "bought", "id", "joined", "m", "days_apart") == want


@pytest.mark.parametrize("bits", [None, 64, 1 << 16])
@pytest.mark.parametrize("values", [[], [1, 2, 2, 7], [1, None], [None]])
def test_not_in_follows_sql(spark, bits, values):
    df = spark.createDataFrame([(x, i) for i, x in enumerate([1, 2, 3, None, 3, 9])], "x int, i int")
    ex = spark.createDataFrame([(v, 0) for v in values], "y int, z int")
    df.createOrReplaceTempView("_df"), ex.createOrReplaceTempView("_ex")
    want = spark.sql("select * from _df where x not in (select y from _ex)")
    assert rows(not_in(df, "x", ex, "y", bits)) == rows(want)


@pytest.mark.parametrize("bits", [None, 128])
def test_drop_excluded_follows_correlated_not_in(spark, bits):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.choice([1, 2, 3, 4, None]), rnd.choice([None, "a", "b", "c"]), i) for i in range(80)],
                               "g int, x string, i int")
    ex = spark.createDataFrame([(1, "a"), (1, "c"), (2, None), (2, "a"), (3, "b"), (None, "a")], "g int, x string")
    df.createOrReplaceTempView("_df"), ex.createOrReplaceTempView("_ex")
    want = spark.sql("select * from _df where x not in (select x from _ex where _ex.g = _df.g)")
    assert rows(drop_excluded(df, ex, ["g"], "x", bits)) == rows(want)
    assert rows(drop_excluded(df, ex.where("false"), ["g"], "x", bits)) == rows(df)


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    held = spark.range(0, 4000, 2)
    bloom = bloom_filter(held, ["id"], 1 << 16)
    assert len(bloom.first()[0]) == 1024
    hits = spark.range(4000).select("id", might_contain(bloom.scalar(), [F.col("id")], 1 << 16).alias("m"))
    assert hits.where("id % 2 = 0 and not m").count() == 0 and hits.where("id % 2 = 1 and m").count() < 40


def test_stored_bitmaps_count_any_union_of_groups(spark):
    rnd = random.Random(6)
    data = [(rnd.randint(1, 12), rnd.choice(["x", "y", None]), rnd.choice([None, rnd.randint(0, 100_000)])) for _ in range(4000)]
    df = spark.createDataFrame(data, "m int, r string, id int")
    stored = stored_ids(df, ["m", "r"], "id")
    for lo, hi in ((1, 12), (3, 5), (7, 7)):
        part = f"m between {lo} and {hi}"
        want = df.where(part).groupBy("r").agg(F.count_distinct("id").alias("n"))
        assert rows(count_stored(stored.where(part), ["r"], "n")) == rows(want)
    assert count_stored(stored, [], "n").first()[0] == len({i for *_, i in data if i is not None})
    assert count_stored(stored.where("false"), [], "n").first()[0] == 0
