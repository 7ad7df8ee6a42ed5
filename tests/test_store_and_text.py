"""Stored tables, string aggregation of hot groups, rejected values, text rules, bucketed layout."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from compare import duck, rows_key
from conftest import SMOKE_SF, rows
from tally.functions.cleaning import STRICT
from tally.functions.semantics import dialect_text, plain_text
from tally.operators.clean import accepted, clean_checked, clean_deliveries, observed, rejected
from tally.operators.lists import string_agg
from tally.plans import bank as K
from tally.plans import loyalty as L
from tally.sources import bind, store
from tally.sources.layout import bucketed


def ids(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x int")


def test_appends_are_published_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        store.read_batches(spark, path)
    assert store.write_batch(ids(spark, 1, 2), path, "day-1")
    assert store.write_batch(ids(spark, 3), path, "day-2")
    assert not store.write_batch(ids(spark, 1, 2), path, "day-1")        # a rerun adds nothing
    assert rows(store.read_batches(spark, path)) == [(1,), (2,), (3,)]
    assert store.write_batch(ids(spark), path, "day-3")                  # an empty batch
    assert rows(store.read_batches(spark, path)) == [(1,), (2,), (3,)]
    for bad in ("a/b", "", "a b"):
        with pytest.raises(ValueError):
            store.write_batch(ids(spark, 1), path, bad)


def test_a_write_that_fails_before_its_marker_leaves_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    store.write_batch(ids(spark, 1), path, "a")

    def fails(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", fails)
        for mode in (store.APPEND, store.REPLACE):
            with pytest.raises(OSError):
                store.write_batch(ids(spark, 7, 8), path, "b", mode)
            assert rows(store.read_batches(spark, path)) == [(1,)]
    assert store.write_batch(ids(spark, 2), path, "b")                   # the rerun starts over
    assert rows(store.read_batches(spark, path)) == [(1,), (2,)]


def test_replace_hides_older_batches_and_unused_files_go(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    for b, x in (("a", 1), ("b", 2)):
        store.write_batch(ids(spark, x), path, b)
    before = store.read_batches(spark, path)
    assert store.write_batch(before.select((F.col("x") * 10).alias("x")), path, "c", store.REPLACE)
    store.write_batch(ids(spark, 5), path, "d")
    monkeypatch.setattr(store, "_publish", lambda *_: None)
    store.write_batch(ids(spark, 9), path, "never")
    store.write_batch(ids(spark, 9), path, "now")
    assert rows(store.read_batches(spark, path)) == [(10,), (20,), (5,)]
    assert store.remove_unused(spark, path, writing=("now",)) == ["a", "b", "never"]
    assert sorted(os.listdir(f"{path}/data")) == ["c", "d", "now"]
    assert rows(store.read_batches(spark, path)) == [(10,), (20,), (5,)]
    assert not store.write_batch(ids(spark, 1), path, "a")               # still known


@pytest.mark.parametrize("piece", [1, 7, 100_000])
def test_string_agg_of_a_hot_group(spark, piece):
    rnd = random.Random(2)
    data = [(rnd.choice([0, 0, None, rnd.randint(1, 9)]), rnd.choice([None, "b", "a", "aa", "", "ä", "Z"])) for _ in range(400)]
    df = spark.createDataFrame(data + [(77, None)], "k int, v string").repartition(5)
    want = {}
    for k, v in data:
        if v is not None:
            want.setdefault(k, []).append(v)
    got = dict(string_agg(df, ["k"], "v", "s", sep="; ", piece_rows=piece).collect())
    assert got == {k: "; ".join(sorted(vs, key=lambda v: v.encode())) for k, vs in want.items()}
    assert string_agg(df.where("false"), ["k"], "v", "s").collect() == []


def test_string_agg_says_when_a_group_is_too_long(spark):
    df = spark.createDataFrame([(1, "abc")] * 10 + [(2, "x")], "k int, v string")
    assert string_agg(df, ["k"], "v", "s", max_chars=39).count() == 2
    with pytest.raises(Exception, match="more than 38 characters"):
        string_agg(df, ["k"], "v", "s", max_chars=38).collect()


RAW = "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string"


@pytest.mark.parametrize("mode", ["reference", STRICT])
def test_rejected_values_are_kept_and_add_up(spark, mode):
    data = [(1, 1, "2021-01-01 18:15:34", "20km", "32 minutes", ""), (2, 1, "soon", "1,234 km", "half an hour", "null"),
            (3, 1, "null", "null", "null", None), (4, 1, None, None, None, None), (5, 2, "", " ", "", ""),
            (6, 2, "2021-01-01 18:15:34", "far", "10", "NULL")]
    raw = spark.createDataFrame(data, RAW)
    checked, seen = observed(clean_checked(raw, mode=mode))
    typed = clean_deliveries(raw, mode).drop("cancellation").join(raw.select("order_id", "cancellation"), "order_id")
    assert rows(accepted(checked)) == rows(typed.select(*raw.columns))
    bad = rows(rejected(checked, ["order_id"]))
    assert bad == sorted([(2, "pickup_time", "soon", "not a time"), (2, "distance", "1,234 km", "not a number"),
                          (2, "duration", "half an hour", "not a whole number"), (6, "distance", "far", "not a number")],
                         key=repr)
    assert seen.get == {"rows": 6, "rows_with_rejects": 2, "rejected_values": 4}
    per = clean_checked(raw, mode=mode).select(F.size("rejects").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    assert tuple(per) == (2, 4)


def test_text_rules_in_groups_joins_and_order(spark):
    df = spark.createDataFrame([("Cheese", 1), ("CHEESE ", 2), ("cheese", 3), (" cheese", 4), ("Bacon", 5), (None, 6), ("", 7),
                                ("  ", 8)], "t string, i int")
    per = df.groupBy(dialect_text("t").alias("t")).agg(F.sum("i").alias("n"))
    assert rows(per.select(plain_text("t").alias("t"), "n")) == sorted(
        [("cheese", 6), (" cheese", 4), ("bacon", 5), (None, 6), ("", 15)], key=repr)
    other = spark.createDataFrame([("cheesE  ", "x")], "t string, x string")
    joined = df.withColumn("t", dialect_text("t")).join(other.withColumn("t", dialect_text("t")), "t")
    assert rows(joined, "i") == [(1,), (2,), (3,)]
    ordered = [r["i"] for r in df.where("i < 6 and i <> 4").orderBy(dialect_text("t"), "i").collect()]
    assert ordered == [5, 1, 2, 3]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    t = bind(spark, SMOKE_SF)
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = bucketed(t.sales, "tally_sales", f"{tmp_path}/sales", ["customer_id"], 6)
        members = bucketed(t.members, "tally_members", f"{tmp_path}/members", ["customer_id"], 6)
        fast, plain = (L.spend_before_join(s, t.menu, m) for s, m in ((sales, members), (t.sales, t.members)))
        joined = sales.join(members, "customer_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in t.sales.join(t.members, "customer_id")._jdf.queryExecution().executedPlan().toString()
        assert rows(fast) == rows(plain)
        assert rows(joined.groupBy("customer_id").count()) == rows(t.sales.join(t.members, "customer_id")
                                                                    .groupBy("customer_id").count())
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
        for name in ("tally_sales", "tally_members"):
            spark.sql(f"drop table if exists {name}")


def test_balances_and_percentiles_with_a_hot_customer(spark):
    """A third of all transactions on one customer and 20 days, against DuckDB's windows."""
    sql = """
SELECT o_orderkey AS txn_id, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(DATE '1996-01-01' + CAST(o_orderkey % 20 AS INTEGER) AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS txn_date,
       CASE o_orderstatus WHEN 'O' THEN 'deposit' ELSE 'purchase' END AS txn_type,
       CAST(floor(o_totalprice) AS BIGINT) AS txn_amount, o_totalprice AS txn_value FROM orders"""
    con = duck(SMOKE_SF)
    data = con.sql(sql).fetchall()
    log = spark.createDataFrame([tuple(r) for r in data], "txn_id long, customer_id long, txn_date date, txn_type string, "
                                                          "txn_amount long, txn_value double").repartition(7)
    signed = f"l AS ({sql}), s AS (SELECT *, CASE txn_type WHEN 'deposit' THEN txn_amount ELSE -txn_amount END AS a FROM l)"
    want = con.sql(f"""WITH {signed} SELECT txn_id, CAST(sum(a) OVER w AS BIGINT), lag(a) OVER w, a - lag(a) OVER w FROM s
                       WINDOW w AS (PARTITION BY customer_id ORDER BY txn_date, txn_id)""").fetchall()
    got = K.running_balance(log).select("txn_id", "balance", "previous_amount", "change")
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(want)
    want = con.sql(f"""WITH {signed} SELECT customer_id, txn_date, a, CAST(sum(a) OVER (
                       PARTITION BY customer_id ORDER BY txn_date) AS BIGINT) FROM s""").fetchall()
    assert rows_key([tuple(r) for r in K.balance_on_day(log).collect()]) == rows_key(want)
    regions = spark.createDataFrame([(0, "hot"), (1, "rest")], "region_id int, region_name string")
    where = log.select("customer_id").distinct().withColumn("region_id", F.when(F.col("customer_id") == 0, 0).otherwise(1))
    got = K.amount_percentiles(log, where, regions, digits=6)
    want = con.sql(f"""WITH {signed}, q AS (SELECT if(customer_id = 0, 'hot', 'rest') AS r, quantile_cont(txn_value, [.5, .8, .95])
                       AS v FROM l GROUP BY 1) SELECT r, round(v[1], 6), round(v[2], 6), round(v[3], 6) FROM q""").fetchall()
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(want)
