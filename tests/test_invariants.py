"""Invariants on the bound test data."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMOKE_SF
from tally.operators.clean import clean_orders
from tally.operators.lists import explode_list
from tally.plans import bank as K
from tally.plans import delivery as V
from tally.plans import loyalty as L
from tally.plans import subscription as U
from tally.sources import bind


def test_u8_shares_sum_to_the_total(spark):
    t = bind(spark, SMOKE_SF)
    s = U.with_plan(t.subscriptions.where(F.col("start_date") <= F.lit("1998-12-31").cast("date")),
                    t.plans)
    per_plan = dict(s.groupBy("plan_name").count().collect())
    total = U.plan_mix_at(t.subscriptions, t.plans, "1998-12-31").first().total_customer
    assert sum(per_plan.values()) == total > 0


def test_k9_last_balance_is_the_sum_of_nets(spark):
    t = bind(spark, SMOKE_SF)
    cb = K.closing_balance(t.customer_transactions)
    last = cb.withColumn("_rn", F.row_number().over(
        Window.partitionBy("customer_id").orderBy(F.col("txn_month").desc()))).where("_rn = 1")
    nets = cb.groupBy("customer_id").agg(F.sum("net_transaction_amt").alias("s"))
    bad = last.join(nets, "customer_id").where(F.col("closing_balance") != F.col("s"))
    assert bad.count() == 0 and last.count() > 0


def test_l11_one_row_per_matched_sale(spark):
    t = bind(spark, SMOKE_SF)
    matched = t.sales.join(t.menu, "product_id").count()
    assert L.membership_table(t.sales, t.menu, t.members).count() == matched > 0


def test_v19_total_is_the_number_of_known_extras(spark):
    t = bind(spark, SMOKE_SF)
    orders = clean_orders(t.customer_orders_raw)
    total = V.top_extras(orders, t.pizza_toppings).agg(F.sum("extras_count")).first()[0]
    items = explode_list(orders, "extras", "i")
    known = items.join(t.pizza_toppings, F.col("i").try_cast("int") == F.col("topping_id")).count()
    assert total == known > 0
