"""Subscription funnel analytics.

Inputs: ``subs`` (customer_id, plan_id, start_date, subscription_id) and
``plans`` (plan_id, plan_name, price).  ``subscription_id`` is the
tie-break for events of one customer on one day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import ci_eq, int_div, pct, year_range
from ..operators.aggs import count_if, flags_per
from ..operators.joins import bounded_broadcast, gaps_at_least
from ..operators.windows import first_per, next_in_order, previous_value

# Plan names used by the analytics.
TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = (
    "trial", "basic monthly", "pro monthly", "pro annual", "churn")

# Day buckets of U11: ten buckets of this width; the last one is open-ended
# and keeps the label of its nominal range.
BUCKET_WIDTH = 30
BUCKET_COUNT = 10


def with_plan(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions joined to their plan (plans is a few literal rows)."""
    return subs.join(bounded_broadcast(plans), "plan_id")


def customer_journey(subs: DataFrame, plans: DataFrame,
                     customer_ids: Iterable[int] | None = None) -> DataFrame:
    """Plan history rows (customer_id, start_date, plan_name, price)."""
    s = subs if customer_ids is None else subs.where(F.col("customer_id").isin(list(customer_ids)))
    return with_plan(s, plans).select(
        "customer_id", "start_date", "plan_name", F.col("price").cast("double").alias("price"))


def customer_count(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Distinct customers with a known plan."""
    return with_plan(subs, plans).agg(F.count_distinct("customer_id").alias("total_customer"))


def starts_by_month(subs: DataFrame, plans: DataFrame, plan_name: str = TRIAL) -> DataFrame:
    """Starts of one plan per month number (years merged)."""
    s = with_plan(subs, plans).where(ci_eq("plan_name", plan_name))
    return s.groupBy(F.month("start_date").alias("month_no")).agg(
        F.count("start_date").alias("start_date_values"))


def starts_of_plans(subs: DataFrame, plans: DataFrame, plan_names: Iterable[str] = (BASIC, PRO_MONTHLY, PRO_ANNUAL)) -> DataFrame:
    """Starts per month of the plans in a list."""
    s = with_plan(subs, plans).where(F.lower("plan_name").isin([p.lower() for p in plan_names]))
    return s.groupBy(F.trunc("start_date", "month").alias("month_start"), "plan_name").agg(
        F.count(F.lit(1)).alias("starts"))


def starts_after_year(subs: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    """U4: events per plan with a start date after ``year``."""
    s = with_plan(subs.where(year_range("start_date", first_year=year + 1)), plans)
    return s.groupBy("plan_name").agg(F.count(F.lit(1)).alias("total_plan"))


def churn_pct(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """100 * churned customers / all customers, 1 decimal."""
    agg = flags_per(with_plan(subs, plans), "customer_id",
                    {"churned": ci_eq("plan_name", CHURN)}, "total")
    return agg.select(pct("churned", "total", 1).alias("round_1decimals"))


def with_next_plan(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Each event with plan name and date of the customer's next event.

    Events without a date come first.  Rows are numbered globally, so neither
    a hot customer nor a hot customer-day meets in one task; ``subscription_id``
    makes them unique.
    """
    return next_in_order(with_plan(subs, plans), "customer_id", ["start_date", "subscription_id"],
                         ["plan_name", "start_date"], prefix="next_", unique=True)


def churn_after_trial_pct(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Trial rows directly followed by churn, per 100 customers, 1 decimal.

    Reference behaviour (quirk Q9): counts rows, not distinct customers.
    """
    s = with_next_plan(subs, plans)
    hit = ci_eq("next_plan_name", CHURN) & ci_eq("plan_name", TRIAL)
    per = s.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        count_if(hit).alias("_hits"))
    agg = per.agg(F.sum("_hits").alias("cust_count"), F.count("customer_id").alias("total"))
    return agg.select(pct("cust_count", "total", 1).alias("churn_percentage_round"))


def next_plan_after_trial(subs: DataFrame, plans: DataFrame,
                          denominator: int | None = 1000) -> DataFrame:
    """Customers whose trial is directly followed by each paid plan or churn.

    Percentages divide by ``denominator`` (1000 in the reference, quirk Q10);
    ``denominator=None`` divides by the real number of customers instead.
    """
    trial = ci_eq("plan_name", TRIAL)
    after = {"total_basic": BASIC, "total_pro": PRO_MONTHLY, "total_annual": PRO_ANNUAL,
             "total_churn": CHURN}
    counts = flags_per(with_next_plan(subs, plans), "customer_id",
                       {n: trial & ci_eq("next_plan_name", p) for n, p in after.items()}, "_customers")
    den = F.lit(denominator) if denominator is not None else F.col("_customers")
    return counts.select(
        "total_basic", "total_pro", "total_annual", "total_churn",
        pct("total_basic", den, 0).alias("basic_pct"),
        pct("total_pro", den, 0).alias("pro_pct"),
        pct("total_annual", den, 0).alias("annual_pct"),
        pct("total_churn", den, 0).alias("churn_pct"),
    )


def plan_mix_at(subs: DataFrame, plans: DataFrame, as_of: _dt.date | str,
                in_force: bool = False) -> DataFrame:
    """U8: share of each plan among subscription rows up to ``as_of``.

    Reference behaviour (quirk Q11) counts every row started on or before
    the date.  ``in_force=True`` counts instead the plan each customer is
    on at that date (the latest row on or before it).
    """
    d = F.lit(str(as_of)).cast("date")
    s = with_plan(subs.where(F.col("start_date") <= d), plans)
    if in_force:
        s = first_per(s, "customer_id", ["start_date", "subscription_id"],
                      ["plan_name"], last=True)
    name = F.lower("plan_name")
    agg = s.agg(
        F.count("customer_id").alias("total_customer"),
        count_if(name == TRIAL, "customer_id").alias("_trial"),
        count_if(name == BASIC, "customer_id").alias("_basic"),
        count_if(name == PRO_MONTHLY, "customer_id").alias("_pro_monthly"),
        count_if(name == PRO_ANNUAL, "customer_id").alias("_pro_annual"),
        count_if(name == CHURN, "customer_id").alias("_churn"),
    )
    t = F.col("total_customer")
    return agg.select(
        "total_customer",
        pct("_trial", t, 1).alias("trial_pct"),
        pct("_basic", t, 1).alias("basic_month_pct"),
        pct("_pro_monthly", t, 1).alias("pro_monthly_pct"),
        pct("_pro_annual", t, 1).alias("pro_annual_pct"),
        pct("_churn", t, 1).alias("churn_pct"),
    )


def upgrades_in_year(subs: DataFrame, plans: DataFrame, year: int,
                     plan_name: str = PRO_ANNUAL) -> DataFrame:
    """Distinct customers starting ``plan_name`` within ``year``."""
    s = with_plan(subs.where(year_range("start_date", year, year)), plans)
    return s.where(ci_eq("plan_name", plan_name)).agg(
        F.count_distinct("customer_id").alias("total"))


def _epoch_day(c: str):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("decimal(38,0)")


def _role_sums(s: DataFrame, start_plan: str, target_plan: str) -> DataFrame:
    """Per customer: dated rows and their day sums of both roles (t, st, a, sa),
    and all rows of both roles, dated or not (every_t, every_a)."""
    dec = "decimal(38,0)"
    dated = F.col("start_date").isNotNull()
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast(dec)
    days = lambda cond: F.sum(F.when(cond & dated, _epoch_day("start_date")).otherwise(0))
    start, target = ci_eq("plan_name", start_plan), ci_eq("plan_name", target_plan)
    return s.where(start | target).groupBy("customer_id").agg(
        one(start & dated).alias("t"), days(start).alias("st"),
        one(target & dated).alias("a"), days(target).alias("sa"),
        one(start).alias("every_t"), one(target).alias("every_a"))


def avg_days_to_plan(subs: DataFrame, plans: DataFrame, start_plan: str = TRIAL,
                     target_plan: str = PRO_ANNUAL) -> DataFrame:
    """Integer average of days from a start-plan row to a target-plan row.

    The source pairs every start row with every target row of the same
    customer (left join; customers without the target drop out of the
    average).  The average over those pairs is computed from per-customer
    sums: with T start rows (day sum St) and A target rows (day sum Sa) a
    customer contributes T*Sa - A*St to the summed differences and T*A
    pairs -- no pair is materialised, and the per-customer sums are
    map-side combined aggregates.
    """
    s = with_plan(subs, plans)
    per_customer = _role_sums(s, start_plan, target_plan)
    tot = per_customer.agg(
        F.sum(F.col("t") * F.col("sa") - F.col("a") * F.col("st")).alias("diff_sum"),
        F.sum(F.col("t") * F.col("a")).alias("pairs"))
    return tot.select(int_div(F.col("diff_sum"), F.col("pairs")).cast("long").alias("average_day"))


def bucket_labels() -> list[tuple[int, int | None, str]]:
    """(low, high, label) of the U11 buckets; high None = open-ended."""
    out = []
    for i in range(BUCKET_COUNT):
        lo = 0 if i == 0 else BUCKET_WIDTH * i + 1
        hi = BUCKET_WIDTH * (i + 1)
        out.append((lo, None if i == BUCKET_COUNT - 1 else hi, f"{lo}-{hi}"))
    return out


def days_to_plan_buckets(subs: DataFrame, plans: DataFrame, start_plan: str = TRIAL,
                         target_plan: str = PRO_ANNUAL) -> DataFrame:
    """The U10 pairs counted and averaged per 30-day bucket.

    Reference behaviour (quirk Q12): the open last bucket is labelled
    '271-300'; start rows without a target row, pairs with a missing date and
    negative gaps fall in a NULL bucket that is counted (only the negative
    gaps enter its average).  Ordered by bucket, the NULL bucket first.

    No pair is materialised: ``gaps_at_least`` counts the pairs with a gap of
    at least each bucket's lower bound (a range join answered by running
    sums), buckets are differences of consecutive counts, and the NULL bucket
    is the total (from per-customer sums, as in U10) minus the pairs with a
    gap of at least 0, plus the start rows of customers without a target.
    """
    s = with_plan(subs, plans)
    name = F.lower("plan_name")
    starts = s.where(name == start_plan).select("customer_id", "start_date")
    targets = s.where(name == target_plan).select("customer_id", "start_date")
    labels = bucket_labels()
    cuts = [lo for lo, _, _ in labels]
    ge = gaps_at_least(starts, targets, "customer_id", "start_date", cuts)

    # buckets: count(gap >= lo) - count(gap >= next lo); the last one is open
    w = Window.orderBy("cut")
    label = None
    for lo, _, text in labels:
        label = (F.when(F.col("cut") == lo, F.lit(text)) if label is None
                 else label.when(F.col("cut") == lo, F.lit(text)))
    zero = F.lit(0).cast("decimal(38,0)")
    buckets = ge.select(
        label.alias("dayss"),
        (F.col("pairs") - F.coalesce(F.lead("pairs").over(w), zero)).alias("_n"),
        (F.col("gap_sum") - F.coalesce(F.lead("gap_sum").over(w), zero)).alias("_s"))
    buckets = buckets.select("dayss", "_n", "_s", F.col("_n").alias("_k"))

    # NULL bucket: negative gaps, plus start rows whose customer has no target
    per_customer = _role_sums(s, start_plan, target_plan)
    # one aggregate over a union: all pairs and lonely start rows (from the
    # per-customer sums), minus the pairs with a non-negative gap
    dec = "decimal(38,0)"
    # pairs with a missing date are counted and have no gap; so are lonely start rows
    all_rows = per_customer.select(
        (F.col("t") * F.col("a")).alias("_k"),
        (F.col("t") * F.col("sa") - F.col("a") * F.col("st")).cast(dec).alias("_s"),
        (F.col("every_t") * F.greatest(F.col("every_a"), F.lit(1)) - F.col("t") * F.col("a"))
        .cast(dec).alias("_lonely"))
    non_negative = ge.where(F.col("cut") == cuts[0]).select(
        (-F.col("pairs")).alias("_k"), (-F.col("gap_sum")).cast(dec).alias("_s"),
        zero.alias("_lonely"))
    neg = all_rows.unionByName(non_negative).agg(
        F.lit(None).cast("string").alias("dayss"),
        F.sum("_k").alias("_k"), F.sum("_s").alias("_s"), F.sum("_lonely").alias("_lonely"))
    neg = neg.select("dayss", (F.col("_k") + F.col("_lonely")).alias("_n"), "_s", "_k")
    out = buckets.unionByName(neg).where(F.col("_n") > 0)
    low = F.split("dayss", "-")[0].cast("int")
    return out.orderBy(low.asc_nulls_first()).select("dayss", F.col("_n").cast("long").alias("number_of_customers"),
                      int_div(F.col("_s"), F.col("_k")).cast("long").alias("average_day"))


def downgrades_in_year(subs: DataFrame, plans: DataFrame, year: int,
                       from_plan: str = PRO_MONTHLY, to_plan: str = BASIC) -> DataFrame:
    """Customers whose ``from_plan`` row is directly followed by a
    ``to_plan`` row starting within ``year`` (a question the source answers
    in prose only)."""
    n = with_next_plan(subs, plans)
    hit = n.where(ci_eq("plan_name", from_plan) & ci_eq("next_plan_name", to_plan)
                  & year_range("next_start_date", year, year))
    return hit.agg(F.count_distinct("customer_id").alias("downgraded_customers"))


def new_customer_growth(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """New customers per month (by the month of their first plan row)
    and the growth over the previous month with new customers:
    100 * (current - previous) / previous, 1 decimal (formula stated in the
    source's prose).

    First starts are a per-customer aggregate; the window then runs over one
    row per month (bounded by the calendar).
    """
    s = with_plan(subs, plans)
    first = s.groupBy("customer_id").agg(F.min("start_date").alias("_first"))
    monthly = first.groupBy(F.trunc("_first", "month").alias("month_start")).agg(
        F.count(F.lit(1)).alias("new_customers"))
    m = previous_value(monthly, [], "month_start", "new_customers", "previous_new_customers")
    return m.select("month_start", "new_customers", "previous_new_customers",
                    pct(F.col("new_customers") - F.col("previous_new_customers"),
                        F.col("previous_new_customers"), 1).alias("growth_pct"))


__all__ = [
    "downgrades_in_year", "new_customer_growth",
    "customer_journey", "customer_count", "starts_by_month", "starts_after_year",
    "churn_pct", "churn_after_trial_pct", "next_plan_after_trial", "plan_mix_at",
    "upgrades_in_year", "avg_days_to_plan", "days_to_plan_buckets", "with_next_plan",
]
