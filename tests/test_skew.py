"""Hot-key data: one customer holds a third of all subscription events, packed
into 20 days (many same-day ties).  The skew-safe plans must still equal the
plain window SQL run by DuckDB on the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compare import duck, rows_key
from conftest import SMOKE_SF
from tally.plans import oracle as O
from tally.plans import loyalty as L
from tally.plans import subscription as U
from tally.sources import bind

# test fixture: the bound subscriptions with a third of the events moved to
# customer 0 on 20 consecutive days
HOT_SQL = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer_id,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
       CASE WHEN o_orderkey % 3 = 0
            THEN CAST(DATE '1996-01-01' + CAST(o_orderkey % 20 AS INTEGER) AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS start_date,
       o_orderkey AS subscription_id
FROM orders"""


def hot_subs(spark):
    o = spark.read.parquet(f"{SMOKE_SF}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    return o.select(
        F.when(hot, F.lit(0).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
        F.when(hot, F.date_add(F.lit("1996-01-01").cast("date"),
                               (F.col("o_orderkey") % 20).cast("int")))
        .otherwise(F.col("o_orderdate").cast("date")).alias("start_date"),
        F.col("o_orderkey").alias("subscription_id"))


def oracle(name: str) -> list:
    sql = O.with_bindings(O.SUBSCRIPTION[name]).replace(
        "subscriptions AS (", f"subscriptions AS ({HOT_SQL}),\n_unused AS (", 1)
    # the downgrade year moves to the hot days of the fixture
    sql = sql.replace("year(after_day) = 1998", "year(after_day) = 1996")
    rel = duck(SMOKE_SF).sql(sql)
    return rel.columns, rel.fetchall()


def test_fixture_is_skewed_and_reaches_the_oracle(spark):
    subs = hot_subs(spark)
    total, hot = subs.count(), subs.where("customer_id = 0").count()
    assert hot * 3 >= total - 3
    name = "subscription_next_plan_after_trial"
    normal = duck(SMOKE_SF).sql(O.with_bindings(O.SUBSCRIPTION[name])).fetchall()
    assert oracle(name)[1] != normal


def test_next_plan_under_skew(spark):
    plans = bind(spark, SMOKE_SF).plans
    for name, fn in [("subscription_next_plan_after_trial", U.next_plan_after_trial),
                     ("subscription_churn_after_trial_pct", U.churn_after_trial_pct),
                     ("subscription_downgrades_in_year",
                      lambda s, p: U.downgrades_in_year(s, p, 1996))]:
        got = fn(hot_subs(spark), plans)
        cols, want = oracle(name)
        idx = [cols.index(c) for c in got.columns]
        assert rows_key([tuple(r) for r in got.collect()]) == rows_key(
            [tuple(r[i] for i in idx) for r in want]), name


def test_day_buckets_under_skew(spark):
    plans = bind(spark, SMOKE_SF).plans
    got = U.days_to_plan_buckets(hot_subs(spark), plans)
    cols, want = oracle("subscription_days_to_annual_buckets")
    idx = [cols.index(c) for c in got.columns]
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(
        [tuple(r[i] for i in idx) for r in want])


# test fixture: the bound sales with a third of the line items moved to
# customer 2 (a member, joined 1997-01-03) on the days around its join date
HOT_SALES_SQL = """
SELECT CASE WHEN l.l_orderkey % 3 = 0 THEN 2 ELSE o.o_custkey END AS customer_id,
       CASE WHEN l.l_orderkey % 3 = 0
            THEN CAST(DATE '1997-01-01' + CAST(l.l_orderkey % 7 AS INTEGER) AS DATE)
            ELSE CAST(o.o_orderdate AS DATE) END AS order_date,
       l.l_partkey AS product_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def hot_sales(spark):
    t = bind(spark, SMOKE_SF)
    li = spark.read.parquet(f"{SMOKE_SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SMOKE_SF}/orders.parquet")
    hot = F.col("l_orderkey") % 3 == 0
    sales = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.when(hot, F.lit(2).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(hot, F.date_add(F.lit("1997-01-01").cast("date"), (F.col("l_orderkey") % 7).cast("int")))
        .otherwise(F.col("o_orderdate").cast("date")).alias("order_date"),
        F.col("l_partkey").alias("product_id"))
    return t, sales


@pytest.mark.parametrize("name,fn", [
    ("loyalty_first_item", lambda t, s: L.first_item(s, t.menu)),
    ("loyalty_favourite_item", lambda t, s: L.favourite_item(s, t.menu)),
    ("loyalty_first_after_join", lambda t, s: L.first_after_join(s, t.menu, t.members)),
    ("loyalty_last_before_join", lambda t, s: L.last_before_join(s, t.menu, t.members)),
    ("loyalty_membership_ranking", lambda t, s: L.membership_ranking(s, t.menu, t.members)),
])
def test_loyalty_under_skew(spark, name, fn):
    t, sales = hot_sales(spark)
    assert sales.where("customer_id = 2").count() * 10 >= sales.count() * 3   # ~a third
    got = fn(t, sales)
    sql = O.with_bindings(O.LOYALTY[name]).replace(
        "sales AS (", f"sales AS ({HOT_SALES_SQL}),\n_unused AS (", 1)
    rel = duck(SMOKE_SF).sql(sql)
    cols, want = rel.columns, rel.fetchall()
    idx = [cols.index(c) for c in got.columns]
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(
        [tuple(r[i] for i in idx) for r in want])


# test fixture: the raw delivery items with a third of the line items moved
# to one delivered order (the smallest delivered order key)
HOT_ITEMS_SQL = """
SELECT n.order_id, o.o_custkey AS customer_id,
       CAST(n.l_partkey % 2 + 1 AS INTEGER) AS pizza_id,
       CASE n.l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'null' WHEN 3 THEN ''
            WHEN 4 THEN '4' WHEN 5 THEN '2, 6' WHEN 6 THEN '' ELSE '4' END AS exclusions,
       CASE (n.l_partkey // 2) % 6 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN ''
            WHEN 3 THEN '1' WHEN 4 THEN '1, 5' ELSE '1, 4' END AS extras,
       strftime(o.o_orderdate + to_minutes(CAST(n.order_id % 1440 AS INTEGER)),
                '%Y-%m-%d %H:%M:%S') AS order_time
FROM (SELECT l.*, CASE WHEN l.l_orderkey % 3 = 0
                       THEN (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus <> 'P')
                       ELSE l.l_orderkey END AS order_id
      FROM lineitem l) n
JOIN orders o ON o.o_orderkey = n.order_id"""


def hot_items(spark):
    """The bound raw items, computed by the same binding over moved line items."""
    li = spark.read.parquet(f"{SMOKE_SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SMOKE_SF}/orders.parquet")
    hot_key = o.where("o_orderstatus <> 'P'").agg(F.min("o_orderkey")).first()[0]
    moved = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(hot_key))
                          .otherwise(F.col("l_orderkey")))
    t = bind(spark, SMOKE_SF)
    load = t._load
    t._load = lambda name: moved if name == "lineitem" else load(name)
    return t.customer_orders_raw, hot_key


@pytest.mark.parametrize("name", [
    "delivery_report", "delivery_avg_pickup_minutes", "delivery_prep_time_by_size",
    "delivery_runner_speed", "delivery_ingredient_lists", "delivery_extras_exploded",
])
def test_delivery_under_skew(spark, name):
    from tally.operators.clean import clean_deliveries, clean_orders
    from tally.plans import catalog as C
    from tally.plans import delivery as V
    t = bind(spark, SMOKE_SF)
    raw, hot_key = hot_items(spark)
    orders = clean_orders(raw)
    assert orders.where(F.col("order_id") == hot_key).count() * 10 >= orders.count() * 3
    dels = clean_deliveries(t.runner_orders_raw)
    recipe = V.recipe_items(t.pizza_recipes, t.pizza_toppings)
    run = {
        "delivery_report": lambda: V.delivery_report(orders, dels, t.rating_source),
        "delivery_avg_pickup_minutes": lambda: V.avg_pickup_minutes(orders, dels),
        "delivery_prep_time_by_size": lambda: V.prep_time_by_size(orders, dels),
        "delivery_runner_speed": lambda: V.runner_speed(orders, dels),
        "delivery_ingredient_lists": lambda: V.ingredient_lists(
            V.order_records(orders), t.pizza_names, recipe),
        "delivery_extras_exploded": lambda: V.extras_exploded(V.order_records(orders)),
    }
    assert name in C.DELIVERY
    got = run[name]()
    sql = O.with_bindings(O.DELIVERY[name]).replace(
        "customer_orders_raw AS (", f"customer_orders_raw AS ({HOT_ITEMS_SQL}),\n_unused AS (", 1)
    rel = duck(SMOKE_SF).sql(sql)
    cols, want = rel.columns, rel.fetchall()
    idx = [cols.index(c) for c in got.columns]
    assert len(want) > 0
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(
        [tuple(r[i] for i in idx) for r in want])


# test fixture: the bound transactions with a third of them moved to customer 0
HOT_TXN_SQL = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer_id,
       CAST(o_orderdate AS DATE) AS txn_date,
       CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'purchase'
            WHEN 'P' THEN 'withdrawal' END AS txn_type,
       CAST(floor(o_totalprice) AS BIGINT) AS txn_amount
FROM orders"""


@pytest.mark.parametrize("name", [
    "bank_avg_deposits", "bank_active_customers_by_month", "bank_closing_balance",
    "bank_balance_growth_pct",
])
def test_bank_under_skew(spark, name):
    from tally.plans import bank as K
    o = spark.read.parquet(f"{SMOKE_SF}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    txns = o.select(
        F.when(hot, F.lit(0).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.when(F.col("o_orderstatus") == "O", "deposit").when(F.col("o_orderstatus") == "F", "purchase")
        .when(F.col("o_orderstatus") == "P", "withdrawal").alias("txn_type"),
        F.floor("o_totalprice").cast("long").alias("txn_amount"))
    assert txns.where("customer_id = 0").count() * 10 >= txns.count() * 3
    fn = {"bank_avg_deposits": K.avg_deposits,
          "bank_active_customers_by_month": K.active_customers_by_month,
          "bank_closing_balance": K.closing_balance,
          "bank_balance_growth_pct": K.balance_growth_pct}[name]
    got = fn(txns)
    sql = O.with_bindings(O.BANK[name]).replace(
        "customer_transactions AS (", f"customer_transactions AS ({HOT_TXN_SQL}),\n_unused AS (", 1)
    rel = duck(SMOKE_SF).sql(sql)
    cols, want = rel.columns, rel.fetchall()
    idx = [cols.index(c) for c in got.columns]
    assert rows_key([tuple(r) for r in got.collect()]) == rows_key(
        [tuple(r[i] for i in idx) for r in want])
