"""Registered analytics: name -> callable(spark, sf_dir) -> DataFrame.

Each entry binds the case tables onto the parquet tables of ``sf_dir`` and
runs one named analytic over the whole tables.  Literal parameters of the
source analytics (years, cut-off dates, plan names, prices) are moved into
the range of the bound data; they are listed here, once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.bindings import CaseTables, bind
from ..functions.cleaning import STRICT
from ..operators.clean import accepted, clean_checked, clean_deliveries, clean_orders, rejected
from . import bank as K
from . import delivery as V
from . import loyalty as L
from . import subscription as U

# Fixed parameters of the registered analytics (chosen inside the date range
# of the bound data, 1995-2001).
AFTER_YEAR = 1998
MIX_AS_OF = "1998-12-31"
UPGRADE_YEAR = 1998
POINTS_PRODUCT = "blue bolt"
BONUS_END = "1998-01-01"
MONTHS = ("1996-11-01", "1997-04-01")
BEFORE_JOIN_DAYS = 30
NEW_PIZZA = (10_000_000, "Supreme", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[CaseTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bind(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


SUBSCRIPTION: dict[str, Query] = {
    "subscription_customer_journey": _q(lambda t: U.customer_journey(t.subscriptions, t.plans)),
    "subscription_customer_count": _q(lambda t: U.customer_count(t.subscriptions, t.plans)),
    "subscription_trial_starts_by_month": _q(lambda t: U.starts_by_month(t.subscriptions, t.plans)),
    "subscription_starts_after_year": _q(
        lambda t: U.starts_after_year(t.subscriptions, t.plans, AFTER_YEAR)),
    "subscription_churn_pct": _q(lambda t: U.churn_pct(t.subscriptions, t.plans)),
    "subscription_churn_after_trial_pct": _q(
        lambda t: U.churn_after_trial_pct(t.subscriptions, t.plans)),
    "subscription_next_plan_after_trial": _q(
        lambda t: U.next_plan_after_trial(t.subscriptions, t.plans)),
    "subscription_plan_mix_at": _q(lambda t: U.plan_mix_at(t.subscriptions, t.plans, MIX_AS_OF)),
    "subscription_upgrades_in_year": _q(
        lambda t: U.upgrades_in_year(t.subscriptions, t.plans, UPGRADE_YEAR)),
    "subscription_avg_days_to_annual": _q(lambda t: U.avg_days_to_plan(t.subscriptions, t.plans)),
    "subscription_days_to_annual_buckets": _q(
        lambda t: U.days_to_plan_buckets(t.subscriptions, t.plans)),
    "subscription_downgrades_in_year": _q(
        lambda t: U.downgrades_in_year(t.subscriptions, t.plans, UPGRADE_YEAR)),
    "subscription_new_customer_growth": _q(
        lambda t: U.new_customer_growth(t.subscriptions, t.plans)),
    "subscription_starts_of_paid_plans": _q(lambda t: U.starts_of_plans(t.subscriptions, t.plans)),
    # corrected variants (Q10, Q11)
    "subscription_next_plan_after_trial_share": _q(
        lambda t: U.next_plan_after_trial(t.subscriptions, t.plans, denominator=None)),
    "subscription_plan_mix_in_force": _q(
        lambda t: U.plan_mix_at(t.subscriptions, t.plans, MIX_AS_OF, in_force=True)),
}


BANK: dict[str, Query] = {
    "bank_unique_nodes": _q(lambda t: K.unique_nodes(t.customer_nodes)),
    "bank_nodes_per_region": _q(lambda t: K.nodes_per_region(t.customer_nodes, t.regions)),
    "bank_customers_per_region": _q(lambda t: K.customers_per_region(t.customer_nodes, t.regions)),
    "bank_avg_reallocation_days": _q(lambda t: K.avg_reallocation_days(t.customer_nodes)),
    "bank_reallocation_percentiles": _q(
        # rounded for the comparison: interpolation differs in the last binary digit
        lambda t: K.reallocation_percentiles(t.customer_nodes, t.regions, digits=9)),
    "bank_txn_totals": _q(lambda t: K.txn_totals(t.customer_transactions)),
    "bank_avg_deposits": _q(lambda t: K.avg_deposits(t.customer_transactions)),
    "bank_active_customers_by_month": _q(
        lambda t: K.active_customers_by_month(t.customer_transactions)),
    "bank_closing_balance": _q(lambda t: K.closing_balance(t.customer_transactions)),
    "bank_balance_growth_pct": _q(lambda t: K.balance_growth_pct(t.customer_transactions)),
    # corrected variant (Q19)
    "bank_balance_growth_corrected": _q(
        lambda t: K.balance_growth_pct(t.customer_transactions, corrected=True)),
    # over single transactions
    "bank_running_balance": _q(lambda t: K.running_balance(t.transaction_log)),
    "bank_balance_on_day": _q(lambda t: K.balance_on_day(t.transaction_log)),
    "bank_amount_percentiles": _q(
        lambda t: K.amount_percentiles(t.transaction_log, t.customer_regions, t.regions, digits=6)),
    "bank_customers_between_months": _q(lambda t: K.customers_between(
        K.customer_bitmaps(t.transaction_log, t.customer_regions), t.regions, *MONTHS)),
}


def _some_without(df: DataFrame, by: str) -> DataFrame:
    """``df`` without a customer in the rows whose ``by`` is divisible by 11."""
    return df.withColumn("customer_id", F.when(F.col(by) % 11 != 0, F.col("customer_id")))


LOYALTY: dict[str, Query] = {
    "loyalty_spend_per_customer": _q(lambda t: L.spend_per_customer(t.sales, t.menu)),
    "loyalty_visit_days": _q(lambda t: L.visit_days(t.sales)),
    "loyalty_first_item": _q(lambda t: L.first_item(t.sales, t.menu)),
    "loyalty_most_purchased": _q(lambda t: L.most_purchased(t.sales, t.menu)),
    "loyalty_favourite_item": _q(lambda t: L.favourite_item(t.sales, t.menu)),
    "loyalty_first_after_join": _q(lambda t: L.first_after_join(t.sales, t.menu, t.members)),
    "loyalty_last_before_join": _q(lambda t: L.last_before_join(t.sales, t.menu, t.members)),
    "loyalty_spend_before_join": _q(lambda t: L.spend_before_join(t.sales, t.menu, t.members)),
    "loyalty_points": _q(lambda t: L.loyalty_points(t.sales, t.menu, POINTS_PRODUCT)),
    "loyalty_bonus_points_until": _q(
        lambda t: L.bonus_points_until(t.sales, t.menu, t.members, BONUS_END)),
    "loyalty_membership_table": _q(lambda t: L.membership_table(t.sales, t.menu, t.members)),
    "loyalty_membership_ranking": _q(
        lambda t: L.membership_ranking(t.sales, t.menu, t.members)),
    # corrected variants (Q2, Q4) and the source's cut-off
    "loyalty_most_purchased_by_count": _q(
        lambda t: L.most_purchased(t.sales, t.menu, by_count=True)),
    "loyalty_bonus_points_first_week": _q(
        lambda t: L.bonus_points_until(t.sales, t.menu, t.members, BONUS_END, first_week_only=True)),
    "loyalty_favourite_item_top7": _q(lambda t: L.favourite_item(t.sales, t.menu, top=7)),
    "loyalty_purchases_before_join": _q(lambda t: L.purchases_before_join(t.sales, t.members, BEFORE_JOIN_DAYS)),
    "loyalty_sales_of_others": _q(lambda t: L.sales_of_others(_some_without(t.sales, "product_id"), t.members)),
    "loyalty_sales_of_others_null_member": _q(
        lambda t: L.sales_of_others(t.sales, _some_without(t.members, "customer_id"))),
    "loyalty_items_per_day": _q(lambda t: L.items_per_day(t.sales, t.menu)),
}


def _orders(t: CaseTables) -> DataFrame:
    return clean_orders(t.customer_orders_raw)


def _deliveries(t: CaseTables) -> DataFrame:
    return clean_deliveries(t.runner_orders_raw)


def _recipe_rows(t: CaseTables) -> DataFrame:
    return V.recipe_items(t.pizza_recipes, t.pizza_toppings)


def _records(t: CaseTables) -> DataFrame:
    """Numbered order items.  Every call numbers the rows that are there now; to
    share the numbers, keep the frame of ``delivery.order_records``."""
    return V.order_records(_orders(t))


DELIVERY: dict[str, Query] = {
    "delivery_clean_orders": _q(_orders),
    "delivery_clean_deliveries": _q(_deliveries),
    "delivery_items_ordered": _q(lambda t: V.items_ordered(_orders(t))),
    "delivery_unique_orders": _q(lambda t: V.unique_orders(_orders(t))),
    "delivery_deliveries_per_runner": _q(lambda t: V.deliveries_per_runner(_deliveries(t))),
    "delivery_delivered_by_type": _q(
        lambda t: V.delivered_by_type(_orders(t), t.pizza_names, _deliveries(t))),
    "delivery_ordered_by_customer_type": _q(
        lambda t: V.ordered_by_customer_type(_orders(t), t.pizza_names)),
    "delivery_max_items_in_order": _q(lambda t: V.max_items_in_order(_orders(t))),
    "delivery_changed_vs_unchanged": _q(
        lambda t: V.changed_vs_unchanged(_orders(t), _deliveries(t))),
    "delivery_both_changes": _q(lambda t: V.both_changes(_orders(t), _deliveries(t))),
    "delivery_volume_by_hour": _q(lambda t: V.volume_by_hour(_orders(t))),
    "delivery_orders_by_weekday": _q(lambda t: V.orders_by_weekday(_orders(t))),
    "delivery_signups_by_week": _q(lambda t: V.signups_by_week(t.runners)),
    "delivery_avg_pickup_minutes": _q(lambda t: V.avg_pickup_minutes(_orders(t), _deliveries(t))),
    "delivery_prep_time_by_size": _q(lambda t: V.prep_time_by_size(_orders(t), _deliveries(t))),
    "delivery_avg_distance_per_customer": _q(
        lambda t: V.avg_distance_per_customer(_orders(t), _deliveries(t))),
    "delivery_time_range": _q(lambda t: V.delivery_time_range(_orders(t), _deliveries(t))),
    "delivery_runner_speed": _q(lambda t: V.runner_speed(_orders(t), _deliveries(t))),
    "delivery_success_pct": _q(lambda t: V.success_pct(_deliveries(t))),
    "delivery_top_extras": _q(lambda t: V.top_extras(_orders(t), t.pizza_toppings)),
    "delivery_top_exclusions": _q(lambda t: V.top_exclusions(_orders(t), t.pizza_toppings)),
    "delivery_order_item_label": _q(lambda t: V.order_item_label(_orders(t), t.pizza_names)),
    "delivery_extras_exploded": _q(lambda t: V.extras_exploded(_records(t))),
    "delivery_exclusions_exploded": _q(lambda t: V.exclusions_exploded(_records(t))),
    "delivery_ingredient_lists": _q(
        lambda t: V.ingredient_lists(_records(t), t.pizza_names, _recipe_rows(t))),
    "delivery_ingredient_totals": _q(
        lambda t: V.ingredient_totals(_orders(t), _deliveries(t), _recipe_rows(t))),
    "delivery_revenue": _q(lambda t: V.revenue(_orders(t), _deliveries(t), t.pizza_names)),
    "delivery_revenue_with_surcharge": _q(
        lambda t: V.revenue_with_surcharge(_orders(t), _deliveries(t), t.pizza_names,
                                           _recipe_rows(t))),
    "delivery_ratings_table": _q(lambda t: V.ratings_table(t.rating_source)),
    "delivery_report": _q(lambda t: V.delivery_report(_orders(t), _deliveries(t), t.rating_source)),
    "delivery_net_revenue": _q(lambda t: V.net_revenue(_orders(t), _deliveries(t), t.pizza_names)),
    # corrected variants (Q5, Q6, Q8, Q13, Q14, Q17, Q18)
    "delivery_max_items_delivered": _q(
        lambda t: V.max_items_in_order(_orders(t), _deliveries(t))),
    "delivery_avg_pickup_minutes_per_order": _q(
        lambda t: V.avg_pickup_minutes(_orders(t), _deliveries(t), per_order=True)),
    "delivery_order_item_composed": _q(
        lambda t: V.order_item_composed(_records(t), t.pizza_names, t.pizza_toppings)),
    "delivery_clean_deliveries_strict": _q(
        lambda t: clean_deliveries(t.runner_orders_raw, STRICT)),
    "delivery_ingredient_lists_corrected": _q(
        lambda t: V.ingredient_lists_corrected(_records(t), t.pizza_names, _recipe_rows(t),
                                               t.pizza_toppings)),
    "delivery_report_by_order": _q(
        lambda t: V.delivery_report(_orders(t), _deliveries(t), t.rating_source, by_order=True)),
    "delivery_net_revenue_per_distance": _q(
        lambda t: V.net_revenue(_orders(t), _deliveries(t), t.pizza_names, per="distance")),
    "delivery_ingredients_left": _q(lambda t: V.ingredients_left(_records(t), _recipe_rows(t))),
    "delivery_items_with_delivery": _q(lambda t: V.items_with_delivery(_orders(t), _deliveries(t))),
    "delivery_cancellations_by_text": _q(lambda t: V.cancellations_by_text(t.runner_orders_dirty)),
    "delivery_rejected_values": _q(lambda t: rejected(clean_checked(t.runner_orders_dirty), ["order_id"])),
    "delivery_accepted_values": _q(lambda t: accepted(clean_checked(t.runner_orders_dirty))),
    # the menu questions over one item per part
    "delivery_menu_with_item": _q(lambda t: V.menu_with_item(t.part_names, t.part_recipes, *NEW_PIZZA)),
    "delivery_recipe_items": _q(lambda t: V.recipe_items(t.part_recipes, t.pizza_toppings)),
    "delivery_standard_ingredients": _q(
        lambda t: V.standard_ingredients(t.part_recipes, t.part_names, t.pizza_toppings)),
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for family in (SUBSCRIPTION, BANK, LOYALTY, DELIVERY):
        out.update(family)
    return out
