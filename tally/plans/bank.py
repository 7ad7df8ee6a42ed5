"""Bank analytics: node reallocation and account balances.

Inputs: ``nodes`` (customer_id, region_id, node_id, start_date, end_date),
``regions`` (region_id, region_name), ``txns`` (customer_id, txn_date,
txn_type, txn_amount).  Open node rows carry the sentinel end date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import days_between, int_avg, int_div, month_floor
from ..operators.aggs import (flags_per, net_amount, percentiles, signed_amount,
                              sum_if, top_k)
from ..operators.distinct import count_stored, stored_ids
from ..operators.joins import bounded_broadcast
from ..operators.quantiles import exact_percentiles
from ..operators.scan import running_in_order
from ..operators.windows import previous_value, running_sum

# The open-ended end date, and the percentile levels with
# their output names.
OPEN_END = "9999-12-31"
PERCENTILES = (0.5, 0.8, 0.95)
PERCENTILE_NAMES = ("median", "p_8", "p_95")


def _closed(nodes: DataFrame, sentinel: str) -> DataFrame:
    return nodes.where(F.col("end_date") != F.lit(sentinel).cast("date"))


def _with_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return nodes.join(bounded_broadcast(regions), "region_id")


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """K1: number of distinct node ids."""
    return nodes.agg(F.count_distinct("node_id").alias("unique_nodes"))


def nodes_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """K2: node rows per region (COUNT, not distinct, as in the source), in
    order of that count."""
    return _with_region(nodes, regions).groupBy("region_name").agg(
        F.count("node_id").alias("number_nodes")).orderBy("number_nodes", "region_name")


def customers_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """K3: distinct customers per region, in order of that count."""
    return _with_region(nodes, regions).groupBy("region_name").agg(
        F.count_distinct("customer_id").alias("customers_count")).orderBy(
        "customers_count", "region_name")


def avg_reallocation_days(nodes: DataFrame, sentinel: str = OPEN_END) -> DataFrame:
    """K4: abs of the integer average of (start - end) days over closed rows."""
    d = days_between(F.col("end_date"), F.col("start_date"))
    return _closed(nodes, sentinel).agg(F.abs(int_avg(d)).alias("avg_days"))


def reallocation_percentiles(nodes: DataFrame, regions: DataFrame,
                             ps: Sequence[float] = PERCENTILES,
                             names: Sequence[str] = PERCENTILE_NAMES,
                             sentinel: str = OPEN_END, digits: int | None = None) -> DataFrame:
    """K5: exact interpolated percentiles of |days| per region (one row each).

    The source computes a windowed percentile for every row and removes the
    duplicates with GROUP BY; one grouped aggregate gives the same rows.
    """
    d = F.abs(days_between(F.col("end_date"), F.col("start_date")))
    n = _with_region(_closed(nodes, sentinel), regions).select("region_name", d.alias("days"))
    return percentiles(n, ["region_name"], "days", ps, names, digits)


def txn_totals(txns: DataFrame) -> DataFrame:
    """K6: rows and summed amount per transaction type."""
    return txns.groupBy("txn_type").agg(
        F.count(F.lit(1)).alias("unique_count"), F.sum("txn_amount").alias("total_amount"))


def avg_deposits(txns: DataFrame, type_pattern: str = "%deposit") -> DataFrame:
    """K7: integer averages over customers of their count and sum of deposits."""
    per_customer = txns.where(F.col("txn_type").ilike(type_pattern)).groupBy(
        "customer_id", "txn_type").agg(
        F.count("txn_type").alias("counts"), F.sum("txn_amount").alias("amounts"))
    per_type = per_customer.groupBy("txn_type").agg(
        int_avg("counts").alias("avg_hist_counts"), int_avg("amounts").alias("avg_amounts"))
    return top_k(per_type, 1, [F.col("txn_type")])


def active_customers_by_month(txns: DataFrame, min_deposits: int = 2) -> DataFrame:
    """K8: per month number (years merged), customers with at least
    ``min_deposits`` deposits and a purchase or a withdrawal that month."""
    t = F.col("txn_type")
    per = txns.groupBy(F.month("txn_date").alias("month_no"), "customer_id").agg(
        sum_if(t.ilike("%deposit")).alias("deposit_count"),
        sum_if(t.ilike("%purchase")).alias("purchase_count"),
        sum_if(t.ilike("%withdrawal")).alias("withdrawal_count"))
    active = per.where((F.col("deposit_count") >= min_deposits)
                       & ((F.col("purchase_count") >= 1) | (F.col("withdrawal_count") >= 1)))
    return active.groupBy("month_no").agg(F.count(F.lit(1)).alias("customers")).orderBy("month_no")


def closing_balance(txns: DataFrame) -> DataFrame:
    """K9: net per (customer, month number) and its running total.

    Months without transactions get no row; the month number merges years
    (as in the source).  The window runs over the monthly aggregate, at most
    12 rows per customer.
    """
    monthly = txns.groupBy("customer_id", F.month("txn_date").alias("txn_month")).agg(
        net_amount("txn_type", "txn_amount").alias("net_transaction_amt"))
    return running_sum(monthly, "customer_id", "txn_month", "net_transaction_amt",
                       "closing_balance", frame="rows")


def balance_growth_pct(txns: DataFrame, threshold: float = 0.05,
                       corrected: bool = False) -> DataFrame:
    """Share of customers whose balance grew by more than ``threshold``.

    Reference behaviour (quirk Q19): growth = (running balance - previous
    month's net) / previous month's net with integer division, so only
    growth of 100 % or more passes; a zero previous net gives NULL (the
    source would fail).  ``corrected=True`` compares the balance with the
    previous month's balance using exact decimal division.
    """
    monthly = txns.groupBy("customer_id", month_floor("txn_date").alias("month_start")).agg(
        F.sum(signed_amount("txn_type", "txn_amount")).alias("total_amount"))
    m = running_sum(monthly, "customer_id", "month_start", "total_amount",
                    "closing_balance", frame="range")
    if corrected:
        m = previous_value(m, "customer_id", "month_start", "closing_balance", "_prev")
        inc = (F.col("closing_balance") - F.col("_prev")).cast("decimal(38,6)") / F.nullif(
            F.col("_prev"), F.lit(0))
    else:
        m = previous_value(m, "customer_id", "month_start", "total_amount", "_prev")
        inc = int_div(F.col("closing_balance") - F.col("_prev"), F.col("_prev"))
    m = m.withColumn("closing_balance_increase", inc)
    agg = flags_per(m, "customer_id", {"customers_with_increase":
                    F.col("closing_balance_increase") > F.lit(threshold)}, "total_customers")
    return agg.select(
        "customers_with_increase", "total_customers",
        int_div(F.col("customers_with_increase") * 100, F.col("total_customers"))
        .alias("percentage_increase"))


def running_balance(log: DataFrame) -> DataFrame:
    """K9 per transaction: the customer's balance after every transaction, and the
    change of the signed amount since the previous one (W7, W8 over raw rows).

    ``log``: txn_id (unique), customer_id, txn_date, txn_type, txn_amount."""
    signed = log.select("txn_id", "customer_id", "txn_date", signed_amount("txn_type", "txn_amount").alias("signed_amount"))
    run = running_in_order(signed, "customer_id", ["txn_date", "txn_id"], {"balance": "signed_amount"},
                           {"previous_amount": "signed_amount"}, unique=True)
    return run.withColumn("change", F.col("signed_amount") - F.col("previous_amount"))


def balance_on_day(log: DataFrame) -> DataFrame:
    """The balance at the end of each transaction's day: all transactions of the
    day count in every row of it (W9, RANGE frame over raw rows)."""
    signed = log.select("customer_id", "txn_date", signed_amount("txn_type", "txn_amount").alias("signed_amount"))
    return running_in_order(signed, "customer_id", "txn_date", {"balance": "signed_amount"}, frame="range")


def amount_percentiles(log: DataFrame, customer_regions: DataFrame, regions: DataFrame,
                       ps: Sequence[float] = PERCENTILES, names: Sequence[str] = PERCENTILE_NAMES,
                       digits: int | None = None) -> DataFrame:
    """K5's percentiles of a continuous column: exact percentiles of the transaction
    values per region, whatever their number of distinct values."""
    named = _with_region(customer_regions, regions).select("customer_id", "region_name")
    return exact_percentiles(log.select("customer_id", "txn_value").join(named, "customer_id"),
                             ["region_name"], "txn_value", ps, names, digits)


def customer_bitmaps(log: DataFrame, customer_regions: DataFrame) -> DataFrame:
    """region_id, month_start, id_range, bits: the customers with transactions, as
    bitmaps that can be stored and merged (K3, K8 without the rows)."""
    by_region = log.select("customer_id", month_floor("txn_date").alias("month_start")).join(customer_regions, "customer_id")
    return stored_ids(by_region, ["region_id", "month_start"], "customer_id")


def customers_between(bitmaps: DataFrame, regions: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Distinct customers per region over any range of months, from stored bitmaps."""
    months = bitmaps.where(F.col("month_start").between(F.lit(first_month).cast("date"), F.lit(last_month).cast("date")))
    return _with_region(count_stored(months, ["region_id"], "customers"), regions).select("region_name", "customers")


__all__ = [
    "unique_nodes", "nodes_per_region", "customers_per_region", "avg_reallocation_days",
    "reallocation_percentiles", "txn_totals", "avg_deposits", "active_customers_by_month",
    "closing_balance", "balance_growth_pct", "running_balance", "balance_on_day",
    "amount_percentiles", "customer_bitmaps", "customers_between",
]
