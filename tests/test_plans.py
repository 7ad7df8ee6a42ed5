"""Plan properties of every registered analytic (the scale claims of the
README, checked on the physical plans)."""

from __future__ import annotations

import re

import pytest

from conftest import SMOKE_SF
from tally.plans import catalog


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # static plans
    try:
        out = {n: fn(spark, SMOKE_SF)._jdf.queryExecution().executedPlan().toString()
               for n, fn in catalog.queries().items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return out


def test_no_python_and_no_pair_joins(plans):
    for name, txt in plans.items():
        assert not re.search(r"EvalPython|PythonUDF|InPandas", txt), name
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, name


def test_input_scans_are_pruned(plans):
    # every scan of a driver table reads only the few columns its binding uses
    for name, txt in plans.items():
        for line in txt.splitlines():
            if "testdata" in line and "ReadSchema" in line:
                schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
                assert schema.count(":") <= 4, (name, schema)


def test_no_row_copies_for_conditional_distinct_counts(plans):
    for name in ("subscription_churn_pct", "subscription_next_plan_after_trial", "bank_balance_growth_pct"):
        assert "Expand" not in plans[name], name


def test_items_are_counted_per_order_before_they_meet_deliveries(plans):
    for name in ("delivery_delivered_by_type", "delivery_changed_vs_unchanged", "delivery_both_changes",
                 "delivery_avg_pickup_minutes", "delivery_prep_time_by_size", "delivery_time_range",
                 "delivery_avg_distance_per_customer", "delivery_runner_speed", "delivery_report",
                 "delivery_revenue", "delivery_revenue_with_surcharge", "delivery_net_revenue",
                 "delivery_ingredient_totals"):
        lines = plans[name].splitlines()
        at = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_orderkey" in x)
        depth = lambda x: re.search(r"[A-Za-z*]", x).start()
        joins, here = 0, depth(lines[at])
        for x in reversed(lines[:at]):          # the operators above the scan, from below
            if depth(x) >= here:
                continue
            here = depth(x)
            if "HashAggregate" in x:
                break
            joins += "Join" in x
        else:
            raise AssertionError(name)
        assert joins <= 1, name                 # only the binding's own join of items and orders


def test_year_filter_reaches_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate",
                     plans["subscription_starts_after_year"])


def test_ingredient_lists_do_not_shuffle_records(plans):
    # after the record ids are materialised, only broadcast joins remain
    txt = plans["delivery_ingredient_lists"]
    assert "SortMergeJoin" not in txt and "BroadcastHashJoin" in txt


def test_fixed_dimensions_are_broadcast_without_the_auto_threshold(spark):
    from tally.operators.joins import bounded_broadcast, estimated_bytes
    from tally.sources import tables
    plans = tables.plans(spark)
    assert 0 < estimated_bytes(plans) < 10_000
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).selectExpr("cast(id % 5 as int) as plan_id")
        txt = fact.join(bounded_broadcast(plans), "plan_id")._jdf.queryExecution() \
            .executedPlan().toString()
        assert "BroadcastHashJoin" in txt
        big = spark.range(10**12).selectExpr("cast(id as int) as plan_id")
        assert estimated_bytes(big) > 10**9
        txt2 = fact.join(bounded_broadcast(big), "plan_id")._jdf.queryExecution() \
            .executedPlan().toString()
        assert "BroadcastHashJoin" not in txt2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_numbered_records_follow_the_data(spark, tmp_path):
    """The same folder with other rows gives other answers, in one application."""
    d = str(tmp_path)
    for t in ("orders", "part", "customer", "nation"):
        spark.read.parquet(f"{SMOKE_SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    items = spark.read.parquet(f"{SMOKE_SF}/lineitem.parquet")
    items.write.parquet(f"{d}/lineitem.parquet")
    run = catalog.queries()["delivery_extras_exploded"]
    assert run(spark, d).count() == run(spark, SMOKE_SF).count()
    items.limit(100).write.mode("overwrite").parquet(f"{d}/lineitem.parquet")
    few = run(spark, d).agg({"record_id": "max"}).first()[0]
    assert few <= 100


def test_intermediate_tables_go_with_the_application(tmp_path):
    """Nothing is left in the checkpoint folder after a session."""
    import subprocess
    import sys

    from conftest import ROOT
    code = f"""
import os, sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
E.queries()["subscription_next_plan_after_trial"](spark, {SMOKE_SF!r}).collect()
print("DURING", sum("tally" in d for _, ds, _ in os.walk({str(tmp_path)!r}) for d in ds))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "DURING 0" not in out.stdout and "DURING" in out.stdout, out.stderr[-2000:]
    import os
    left = [d for _, ds, _ in os.walk(tmp_path) for d in ds if "tally" in d]
    assert left == []


def test_release_work_empties_the_folder(spark):
    from tally.operators import with_dense_id
    from tally.session import ensure_checkpoint_dir, hadoop_path, release_work
    release_work(spark)
    with_dense_id(spark.range(10).toDF("x"), ["x"]).collect()
    assert release_work(spark) == 1
    fs, path = hadoop_path(spark, ensure_checkpoint_dir(spark))
    assert fs.exists(path) and len(fs.listStatus(path)) == 0
