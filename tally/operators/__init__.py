"""Reusable DataFrame operators."""

from .aggs import (count_if, flags_per, net_amount, percentiles, signed_amount,
                   sum_if, top_k)
from .anti import drop_excluded, not_in
from .bands import within_days
from .clean import (accepted, clean_checked, clean_deliveries, clean_orders, rejected,
                    with_record_id)
from .distinct import count_stored, stored_ids
from .ids import with_dense_id
from .joins import bounded_broadcast, flag_membership, gaps_at_least
from .lists import explode_list, sorted_text_list, string_agg
from .quantiles import exact_percentiles
from .scan import running_in_order
from .skew import hot_join
from .windows import (first_per, join_ranks, next_in_order, previous_value, rank_top,
                      rank_within, ranks_of, running_sum)

__all__ = [
    "count_if", "flags_per", "net_amount", "percentiles", "signed_amount", "sum_if",
    "top_k", "clean_deliveries", "clean_orders", "with_record_id", "with_dense_id",
    "bounded_broadcast", "flag_membership", "gaps_at_least",
    "accepted", "clean_checked", "rejected", "drop_excluded", "not_in", "within_days", "count_stored",
    "stored_ids", "string_agg", "exact_percentiles", "running_in_order", "hot_join",
    "explode_list", "sorted_text_list", "first_per", "join_ranks", "next_in_order",
    "previous_value", "rank_top", "rank_within", "ranks_of", "running_sum",
]
