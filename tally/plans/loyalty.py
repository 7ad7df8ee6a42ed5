"""Loyalty / restaurant-sales analytics.

Inputs: ``sales`` (customer_id, order_date, product_id), ``menu``
(product_id, product_name, price), ``members`` (customer_id, join_date).

Sales are joined to the menu first and aggregated after the join: a
(customer, product) pair rarely repeats, so aggregating per pair before the
join would not shrink the data and would add a second shuffle keyed
differently from the join.  Aggregates that do shrink the data a lot (per
product, per customer) run before the menu join.  Ties on the order date
are broken by ``product_id`` (quirk Q1).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import ci_eq
from ..operators.aggs import top_k
from ..operators.anti import BLOOM_BITS, not_in
from ..operators.bands import within_days
from ..operators.joins import flag_membership
from ..operators.lists import string_agg
from ..operators.windows import first_per, join_ranks, rank_top, ranks_of


def _money(c):
    return c.cast("double")


def spend_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """L1: total price of all purchases per customer."""
    return sales.join(menu, "product_id").groupBy("customer_id").agg(
        _money(F.sum("price")).alias("total_amount"))


def visit_days(sales: DataFrame) -> DataFrame:
    """L2: distinct order dates per customer."""
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("visited_days"))


def first_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """L3: name of the first product each customer bought.

    The first (order_date, product_id) per customer is an aggregate over
    sales alone; the menu is joined to one row per customer afterwards
    (left join: unknown products give a NULL name, as in the source).
    """
    first = first_per(sales, "customer_id", ["order_date", "product_id"], ["product_id"])
    return first.join(menu, "product_id", "left").select(
        "customer_id", F.col("product_name").alias("first_item"))


def most_purchased(sales: DataFrame, menu: DataFrame, by_count: bool = False) -> DataFrame:
    """L4: the product with its purchase count, TOP 1.

    Reference behaviour (quirk Q2): TOP 1 by ``product_id`` descending, not
    by count.  ``by_count=True`` takes the most purchased product (ties to
    the lower id).
    """
    counts = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    per = counts.join(menu, "product_id").groupBy("product_id", "product_name").agg(
        F.sum("_n").alias("total_purchased_by_customers"))
    order = ([F.col("total_purchased_by_customers").desc(), F.col("product_id").asc()]
             if by_count else [F.col("product_id").desc(), F.col("product_name").asc()])
    return top_k(per, 1, order).select(
        "product_id", F.col("product_name").alias("most_purchased_item"),
        "total_purchased_by_customers")


def favourite_item(sales: DataFrame, menu: DataFrame, top: int | None = None) -> DataFrame:
    """Each customer's most bought product(s); ties all kept.

    The source cuts the per-(customer, product) counts to TOP 7 ordered by
    customer (quirk Q3, a cut-off fitted to a 7-row dataset); by default no
    cut is applied.  ``top=k`` applies it, ordered by (customer, product)
    so the cut is deterministic (T6).
    """
    per = sales.join(menu, "product_id").groupBy(
        "customer_id", "product_id", "product_name").agg(F.count(F.lit(1)).alias("counts"))
    if top is not None:
        per = top_k(per, top, [F.col("customer_id"), F.col("product_id")])
    best = rank_top(per, "customer_id", "counts", largest=True)
    return best.select("customer_id", "product_name")


def _member_sales(sales: DataFrame, members: DataFrame) -> DataFrame:
    return sales.join(members, "customer_id")


def first_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """First purchase(s) on or after the join date (all items of that day)."""
    s = _member_sales(sales, members).where(F.col("order_date") >= F.col("join_date"))
    s = s.join(menu, "product_id")
    return rank_top(s, "customer_id", "order_date").select("customer_id", F.col("join_date").alias("became_member"),
                      F.col("order_date").alias("first_purchased"),
                      F.col("product_name").alias("item"))


def last_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Item bought last before the join date, with that date.

    The item is the last product name per customer under
    (order_date, product_id), as the full-frame LAST_VALUE window gives it,
    and the date is max(order_date) per (customer, join date).  Both come
    from one aggregate pass over the purchases per (customer, join date);
    the item of a customer is then the last of its (at most a few) groups,
    taken by a window over those aggregated rows, so the purchases are read
    and joined once.
    """
    s = _member_sales(sales, members).where(F.col("order_date") < F.col("join_date"))
    s = s.join(menu, "product_id")
    per = s.groupBy("customer_id", "join_date").agg(
        F.max(F.struct("order_date", "product_id", "product_name")).alias("_last"),
        F.max("order_date").alias("just_before_join_order_date"))
    item = F.max("_last").over(Window.partitionBy("customer_id"))
    return per.select(
        "customer_id", item.getField("product_name").alias("item_purchased"), "join_date",
        "just_before_join_order_date")


def purchases_before_join(sales: DataFrame, members: DataFrame, days: int = 30) -> DataFrame:
    """Every purchase within ``days`` days before joining (J6 as a band join)."""
    return within_days(sales, members, "customer_id", "order_date", "join_date", 1, days, "days_before").select(
        "customer_id", "join_date", "order_date", "product_id", "days_before")


def sales_of_others(sales: DataFrame, members: DataFrame) -> DataFrame:
    """Sales whose customer is not in the members (J8: NOT IN against a query,
    null-aware): with a NULL among the members there are none, and sales without a
    customer do not count."""
    return not_in(sales, "customer_id", members, bloom_bits=BLOOM_BITS).select("customer_id", "order_date", "product_id")


def items_per_day(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """The names of all items sold on a day, in order (A18 for groups of any size)."""
    named = sales.join(menu, "product_id").select("order_date", "product_name")
    return string_agg(named, ["order_date"], "product_name", "items", sep=", ")


def spend_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Purchases and amount per member before joining."""
    s = _member_sales(sales, members).where(F.col("order_date") < F.col("join_date"))
    s = s.join(menu, "product_id", "left")
    return s.groupBy("customer_id").agg(
        F.count("product_id").alias("total_items"), _money(F.sum("price")).alias("total_amount"))


def loyalty_points(sales: DataFrame, menu: DataFrame, special_product: str,
                   base: int = 10, special: int = 20) -> DataFrame:
    """points = ``special`` x price for the named product (case-insensitive),
    ``base`` x price otherwise, summed per customer."""
    pts = menu.select("product_id", F.when(ci_eq("product_name", special_product),
                                           F.col("price") * special)
                      .otherwise(F.col("price") * base).alias("points"))
    return sales.join(pts, "product_id").groupBy("customer_id").agg(
        _money(F.sum("points")).alias("total_points"))


def bonus_points_until(sales: DataFrame, menu: DataFrame, members: DataFrame,
                       end: _dt.date | str, multiplier: int = 20,
                       first_week_only: bool = False) -> DataFrame:
    """``multiplier`` x price for purchases from the join date up to ``end``.

    Reference behaviour (quirk Q4) doubles every purchase from the join date
    to the end date; ``first_week_only=True`` limits it to the first 7 days.
    """
    d = F.col("order_date")
    cond = (d >= F.col("join_date")) & (d < F.lit(str(end)).cast("date"))
    if first_week_only:
        cond = cond & d.between(F.col("join_date"), F.date_add(F.col("join_date"), 6))
    s = _member_sales(sales, members).where(cond).join(menu, "product_id")
    return s.groupBy("customer_id").agg(
        _money(F.sum(F.col("price") * multiplier)).alias("total_points"))


def membership_table(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every purchase with product, price and member flag Y/N."""
    s = sales.join(menu, "product_id")
    s = flag_membership(s, members, "customer_id", "order_date", "join_date", "member")
    return s.select("customer_id", "order_date", "product_name",
                    _money(F.col("price")).alias("price"), "member")


def membership_ranking(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """L11 plus the rank of each member purchase by date within
    (customer, flag); NULL for non-member rows.

    Only member rows are ranked, from counts per (customer, date) over the
    columns that decides on: the menu contributes its key alone.
    """
    t = membership_table(sales, menu, members)
    flagged = flag_membership(sales.join(menu.select("product_id"), "product_id"), members,
                              "customer_id", "order_date", "join_date", "member")
    ranks = ranks_of(flagged.where(F.col("member") == "Y"), ["customer_id", "member"], "order_date", "_rank")
    r = join_ranks(t, ranks, ["customer_id", "member", "order_date"], "_rank")
    return r.select("customer_id", "order_date", "product_name", "price", "member",
                    F.col("_rank").cast("int").alias("ranking"))
