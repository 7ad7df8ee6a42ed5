"""The Spark bindings and the oracle's SQL bindings describe the same rows."""

from __future__ import annotations

import pytest

from compare import duck, rows_key
from conftest import SMOKE_SF
from tally.operators.clean import clean_deliveries, clean_orders
from tally.plans.oracle import BINDINGS
from tally.sources.bindings import bind

SPARK_SIDE = {
    "sales": lambda t: t.sales,
    "menu": lambda t: t.menu,
    "members": lambda t: t.members,
    "customer_orders_raw": lambda t: t.customer_orders_raw,
    "runner_orders_raw": lambda t: t.runner_orders_raw,
    "customer_orders": lambda t: clean_orders(t.customer_orders_raw),
    "runner_orders": lambda t: clean_deliveries(t.runner_orders_raw),
    "runners": lambda t: t.runners,
    "pizza_names": lambda t: t.pizza_names,
    "pizza_recipes": lambda t: t.pizza_recipes,
    "pizza_toppings": lambda t: t.pizza_toppings,
    "subscriptions": lambda t: t.subscriptions,
    "plans": lambda t: t.plans,
    "regions": lambda t: t.regions,
    "customer_nodes": lambda t: t.customer_nodes,
    "customer_transactions": lambda t: t.customer_transactions,
    "transaction_log": lambda t: t.transaction_log,
    "customer_regions": lambda t: t.customer_regions,
    "runner_orders_dirty": lambda t: t.runner_orders_dirty,
}


@pytest.mark.parametrize("table", sorted(SPARK_SIDE))
def test_binding_matches_oracle(spark, table):
    sdf = SPARK_SIDE[table](bind(spark, SMOKE_SF))
    rel = duck(SMOKE_SF).sql(f"WITH {BINDINGS} SELECT * FROM {table}")
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [list(rel.columns).index(c) for c in sdf.columns]
    d_rows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    s_rows = [tuple(r) for r in sdf.collect()]
    assert len(s_rows) == len(d_rows) and len(s_rows) > 0
    assert rows_key(s_rows) == rows_key(d_rows)
