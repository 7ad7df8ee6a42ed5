"""Every registered analytic against its DuckDB oracle SQL (sf0.001), plus
the driver contract (entry / queries / oracle_sql)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SMOKE_SF


def test_contract_keys_match():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 64
    families = ("subscription_", "bank_", "loyalty_", "delivery_")
    own = [n for n in qs if n.startswith(families)]
    assert len(own) >= 80 and set(own) <= set(sql)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["total_basic", "total_pro", "total_annual", "total_churn"]
    assert df.count() == 1


@pytest.mark.parametrize("family", ["subscription", "bank", "loyalty", "delivery"])
def test_family_matches_oracle(spark, family):
    names = [n for n in E.queries() if n.startswith(family)]
    res = compare(spark, SMOKE_SF, names, verbose=False)
    bad = {n: r for n, r in res.items() if r[0] != "ok" or r[3]}
    assert not bad, bad
