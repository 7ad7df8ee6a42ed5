"""Case tables bound onto the driver's parquet tables.

The source analytics run over four business datasets that are not shipped.
Each case table is defined here as a projection / join of the TPC-H-style
tables, so every analytic reads the given tables and its work grows with
them.  The raw delivery tables deliberately contain the dirty text forms
the cleaning stage has to handle ('null' text, NULL, blanks, unit
suffixes in several spellings, mixed-case cancellation notes).

The same definitions are written independently in DuckDB SQL in
``tally.plans.oracle`` (``BINDINGS``); the two must describe the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..operators.skew import sized_join
from . import tables

# Fixed values of the bindings (also used by the oracle SQL).
MEMBER_SEGMENTS = ("BUILDING", "MACHINERY", "HOUSEHOLD")
MEMBER_EPOCH = "1997-01-01"       # join_date = epoch + custkey % 365 days
RUNNER_EPOCH = "2021-01-01"       # registration_date = epoch + suppkey % 60 days
OPEN_END_DATE = "9999-12-31"      # customer_nodes.end_date of open rows
CHEESE_TOPPING_ID = 4             # nation 4 is renamed to this topping name
CHEESE_TOPPING_NAME = "Cheese"
TXN_TYPES = {"O": "deposit", "F": "purchase", "P": "withdrawal"}


def _minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def _ts_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' (the bound times have whole seconds)."""
    return ts.cast("string")


def _text(x: Column) -> Column:
    return x.cast("string")


class CaseTables:
    """Lazily bound case tables for one data directory.

    Every property returns a DataFrame (a logical plan); nothing is read
    until an analytic runs.  Only the columns each binding needs are
    selected, so the parquet scans are pruned.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _load(self, name: str) -> DataFrame:
        return tables.load(self.spark, self.sf_dir, name)

    # ---------------------------------------------------------------- loyalty
    @cached_property
    def sales(self) -> DataFrame:
        li = self._load("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey")
        o = self._load("orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate")
        return sized_join(li, o, ["order_id"]).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    @cached_property
    def menu(self) -> DataFrame:
        return self._load("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        )

    @cached_property
    def members(self) -> DataFrame:
        c = self._load("customer").select("c_custkey", "c_mktsegment")
        return c.where(F.col("c_mktsegment").isin(*MEMBER_SEGMENTS)).select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(F.lit(MEMBER_EPOCH).cast("date"),
                       (F.col("c_custkey") % 365).cast("int")).alias("join_date"),
        )

    # --------------------------------------------------------------- delivery
    @cached_property
    def customer_orders_raw(self) -> DataFrame:
        li = self._load("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber")
        o = self._load("orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate")
        j = sized_join(li, o, ["order_id"])
        line = F.col("l_linenumber")
        exclusions = (F.when(line == 1, F.lit(None).cast("string"))
                      .when(line == 2, "null").when(line == 3, "")
                      .when(line == 4, "4").when(line == 5, "2, 6")
                      .when(line == 6, "").otherwise("4"))
        xk = F.call_function("div", F.col("l_partkey"), F.lit(2)) % 6
        extras = (F.when(xk == 0, F.lit(None).cast("string"))
                  .when(xk == 1, "null").when(xk == 2, "")
                  .when(xk == 3, "1").when(xk == 4, "1, 5").otherwise("1, 4"))
        order_ts = _minutes_after(F.col("o_orderdate"), (F.col("order_id") % 1440).cast("int"))
        return j.select(
            "order_id",
            F.col("o_custkey").alias("customer_id"),
            (F.col("l_partkey") % 2 + 1).cast("int").alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
            _ts_text(order_ts).alias("order_time"),
        )

    @cached_property
    def runner_orders_raw(self) -> DataFrame:
        o = self._load("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        k = F.col("o_orderkey")
        delivered = F.col("o_orderstatus") != "P"
        missing = F.when(k % 4 == 1, F.lit(None).cast("string")).otherwise(F.lit("null"))
        order_ts = _minutes_after(F.col("o_orderdate"), (k % 1440).cast("int"))
        pickup_ts = _minutes_after(order_ts, ((k * 7) % 45 + 1).cast("int"))
        # Each text is built from shared pieces (the number once, then an
        # optional decimal part and a unit chosen by a small CASE) so that the
        # expression stays compact when Catalyst inlines it into filters.
        tenths = k % 230 + 20
        r4 = k % 4
        distance = F.concat(
            _text(F.call_function("div", tenths, F.lit(10))),
            F.when(r4 != 3, F.concat(F.lit("."), _text(tenths % 10))).otherwise(F.lit("")),
            F.when(r4 == 0, F.lit("km")).when(r4 == 1, F.lit(" km")).otherwise(F.lit("")))
        dk = F.call_function("div", k, F.lit(4)) % 4
        duration = F.concat(
            _text(k % 31 + 10),
            F.when(dk == 0, F.lit(" minutes")).when(dk == 1, F.lit(" minute"))
            .when(dk == 2, F.lit("mins")).otherwise(F.lit("")))
        cancellation = (F.when(delivered & (k % 3 == 0), F.lit(None).cast("string"))
                        .when(delivered & (k % 3 == 1), F.lit("null"))
                        .when(delivered, F.lit(""))
                        .when(k % 2 == 0, F.lit("Restaurant Cancellation"))
                        .otherwise(F.lit("customer cancellation")))
        return o.select(
            k.alias("order_id"),
            (k % 10 + 1).cast("int").alias("runner_id"),
            F.when(delivered, _ts_text(pickup_ts)).otherwise(missing).alias("pickup_time"),
            F.when(delivered, distance).otherwise(missing).alias("distance"),
            F.when(delivered, duration).otherwise(missing).alias("duration"),
            cancellation.alias("cancellation"),
        )

    @cached_property
    def runner_orders_dirty(self) -> DataFrame:
        """Raw deliveries with texts that cleaning cannot read, some spelled oddly."""
        raw, k = self.runner_orders_raw, F.col("order_id")
        text = {"distance": (17, 3, "about 12km"), "duration": (19, 5, "ten minutes"), "pickup_time": (23, 7, "soon")}
        odd = F.when(k % 3 == 0, F.upper("cancellation")).when(k % 3 == 1, F.concat("cancellation", F.lit("  "))).otherwise(
            F.col("cancellation"))
        return raw.select("order_id", "runner_id", *[
            F.when(k % m == r, F.lit(t)).otherwise(F.col(c)).alias(c)
            for c, (m, r, t) in sorted(text.items(), key=lambda x: raw.columns.index(x[0]))],
            odd.alias("cancellation")).select(*raw.columns)

    @cached_property
    def runners(self) -> DataFrame:
        s = self._load("supplier").select("s_suppkey")
        return s.select(
            F.col("s_suppkey").alias("runner_id"),
            F.date_add(F.lit(RUNNER_EPOCH).cast("date"),
                       (F.col("s_suppkey") % 60).cast("int")).alias("registration_date"),
        )

    @cached_property
    def pizza_names(self) -> DataFrame:
        return tables.pizza_names(self.spark)

    @cached_property
    def pizza_recipes(self) -> DataFrame:
        return tables.pizza_recipes(self.spark)

    @cached_property
    def pizza_toppings(self) -> DataFrame:
        n = self._load("nation").select("n_nationkey", "n_name")
        return n.select(
            F.col("n_nationkey").alias("topping_id"),
            F.when(F.col("n_nationkey") == CHEESE_TOPPING_ID, F.lit(CHEESE_TOPPING_NAME))
            .otherwise(F.col("n_name")).alias("topping_name"),
        )

    @cached_property
    def rating_source(self) -> DataFrame:
        """One rating per delivered order (before ids are assigned)."""
        o = self._load("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        k = F.col("o_orderkey")
        return o.where(F.col("o_orderstatus") != "P").select(
            k.alias("order_id"),
            (k % 10 + 1).cast("int").alias("runner_id"),
            F.col("o_custkey").alias("customer_id"),
            (k % 5 + 1).cast("int").alias("rating"),
        )

    # ----------------------------------------------------------- subscription
    @cached_property
    def subscriptions(self) -> DataFrame:
        o = self._load("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        return o.select(
            F.col("o_custkey").alias("customer_id"),
            (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.col("o_orderkey").alias("subscription_id"),
        )

    @cached_property
    def plans(self) -> DataFrame:
        return tables.plans(self.spark)

    # a menu that grows with the data: one item per part, three toppings each
    @cached_property
    def part_names(self) -> DataFrame:
        return self._load("part").select(F.col("p_partkey").alias("pizza_id"),
                                         F.col("p_name").alias("pizza_name"))

    @cached_property
    def part_recipes(self) -> DataFrame:
        k = F.col("p_partkey")
        return self._load("part").select(k.alias("pizza_id"), F.concat_ws(
            ", ", _text(k % 25), _text((k + 8) % 25), _text((k + 17) % 25)).alias("toppings"))

    # ------------------------------------------------------------------- bank
    @cached_property
    def regions(self) -> DataFrame:
        return self._load("region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    @cached_property
    def customer_nodes(self) -> DataFrame:
        o = self._load("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        c = self._load("customer").select("c_custkey", "c_nationkey")
        n = self._load("nation").select("n_nationkey", "n_regionkey")
        # nation has a fixed size (25 rows): broadcast behind the size check
        cust_region = c.join(bounded_broadcast(n), c.c_nationkey == n.n_nationkey).select(
            "c_custkey", "n_regionkey")
        j = o.join(cust_region, o.o_custkey == cust_region.c_custkey)
        start = F.col("o_orderdate").cast("date")
        k = F.col("o_orderkey")
        return j.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("n_regionkey").alias("region_id"),
            (k % 5 + 1).cast("int").alias("node_id"),
            start.alias("start_date"),
            F.when(F.col("o_orderstatus") == "O", F.lit(OPEN_END_DATE).cast("date"))
            .otherwise(F.date_add(start, (k % 29).cast("int"))).alias("end_date"),
        )

    @cached_property
    def customer_transactions(self) -> DataFrame:
        o = self._load("orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
        status = F.col("o_orderstatus")
        txn_type = F.lit(None).cast("string")
        for code, name in TXN_TYPES.items():
            txn_type = F.when(status == code, F.lit(name)).otherwise(txn_type)
        return o.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
            txn_type.alias("txn_type"),
            F.floor("o_totalprice").cast("long").alias("txn_amount"),
        )

    @cached_property
    def transaction_log(self) -> DataFrame:
        """Single transactions, with an id and the amount as measured."""
        o = self._load("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
        status = F.col("o_orderstatus")
        txn_type = F.lit(None).cast("string")
        for code, name in TXN_TYPES.items():
            txn_type = F.when(status == code, F.lit(name)).otherwise(txn_type)
        return o.select(
            F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("txn_date"), txn_type.alias("txn_type"),
            F.floor("o_totalprice").cast("long").alias("txn_amount"),
            F.col("o_totalprice").alias("txn_value"))

    @cached_property
    def customer_regions(self) -> DataFrame:
        c = self._load("customer").select("c_custkey", "c_nationkey")
        n = self._load("nation").select("n_nationkey", "n_regionkey")
        return c.join(bounded_broadcast(n), c.c_nationkey == n.n_nationkey).select(
            F.col("c_custkey").alias("customer_id"), F.col("n_regionkey").alias("region_id"))


def bind(spark: SparkSession, sf_dir: str) -> CaseTables:
    return CaseTables(spark, sf_dir)
