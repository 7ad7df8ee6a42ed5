"""Column-level rules: dialect semantics and cleaning parsers."""

from .cleaning import (REFERENCE, STRICT, blank_null_like, list_items, parse_int,
                       parse_number, parse_ts)
from .semantics import (ci_eq, ci_like, concat_text, days_between, int_avg,
                        int_div, measured_sum, minutes_crossed, month_floor, pct,
                        round_half, round_ratio, us_week, weekday_name, year_range)

__all__ = [
    "REFERENCE", "STRICT", "blank_null_like", "list_items",
    "parse_int", "parse_number", "parse_ts", "ci_eq", "ci_like", "concat_text",
    "days_between", "int_avg", "int_div", "measured_sum", "minutes_crossed",
    "month_floor", "pct", "round_half", "round_ratio", "us_week", "weekday_name",
    "year_range",
]
