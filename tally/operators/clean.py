"""Whole cleaning stages for the delivery tables (C7) and record ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cleaning import (REFERENCE, STRICT, blank_null_like, blank_or_null_text, parse_int,
                                  parse_number, parse_ts)
from .ids import with_dense_id

ORDER_RECORD_KEY = ("order_id", "customer_id", "pizza_id", "exclusions", "extras", "order_time")


def clean_orders(raw: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """customer_orders: null-like lists -> '', order_time -> timestamp."""
    return raw.select(
        *[c for c in raw.columns if c not in ("exclusions", "extras", "order_time")],
        blank_null_like("exclusions").alias("exclusions"),
        blank_null_like("extras").alias("extras"),
        parse_ts(F.col("order_time").cast("string"), mode).alias("order_time"),
    ).select(*raw.columns)


def clean_deliveries(raw: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """runner_orders: 'null' text treated as blank, units stripped, typed columns.

    ``mode='reference'`` turns blanks into 0 / 0.0 / 1900-01-01 like the
    source's in-place type change; ``mode='strict'`` turns them into NULL.
    """
    return raw.select(
        *[c for c in raw.columns
          if c not in ("pickup_time", "distance", "duration", "cancellation")],
        parse_ts("pickup_time", mode).alias("pickup_time"),
        parse_number("distance", mode).alias("distance"),
        parse_int("duration", mode).alias("duration"),
        blank_null_like("cancellation").alias("cancellation"),
    ).select(*raw.columns)


def with_record_id(orders: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Cleaned customer_orders plus a stable dense ``record_id`` ordered by
    all of its columns (rows equal in every column are interchangeable)."""
    return with_dense_id(orders, list(ORDER_RECORD_KEY), id_col)


# How the typed columns of a delivery are read, and what to say of texts that cannot be.
DELIVERY_PARSERS: dict[str, tuple[Callable, str]] = {
    "pickup_time": (parse_ts, "not a time"),
    "distance": (parse_number, "not a number"),
    "duration": (parse_int, "not a whole number"),
}


def clean_checked(raw: DataFrame, parsers: Mapping[str, tuple[Callable[..., Column], str]] = DELIVERY_PARSERS,
                  mode: str = REFERENCE, out: str = "rejects") -> DataFrame:
    """``raw`` with the columns of ``parsers`` typed, and with ``out``: an array of
    (column_name, raw_text, reason), one entry for every text of the row that is
    neither blank, nor 'null', nor readable, and has therefore become NULL.

    One pass over the rows.  ``accepted`` and ``rejected`` take the two results
    from it; write the frame (for instance with ``sources.store``) if both are
    needed from one reading of the input."""
    entries = []
    for name, (parse, reason) in parsers.items():
        text = F.col(name).cast("string")
        bad = text.isNotNull() & ~blank_or_null_text(text) & parse(text, STRICT).isNull()
        entries.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), text.alias("raw_text"),
                                            F.lit(reason).alias("reason"))))
    typed = [parsers[c][0](F.col(c).cast("string"), mode).alias(c) if c in parsers else F.col(c) for c in raw.columns]
    return raw.select(*typed, F.filter(F.array(*entries), lambda e: e.isNotNull()).alias(out))


def accepted(checked: DataFrame, out: str = "rejects") -> DataFrame:
    """The typed rows, all of them (unreadable values are NULL)."""
    return checked.drop(out)


def rejected(checked: DataFrame, keys: list[str], out: str = "rejects") -> DataFrame:
    """keys, column_name, raw_text, reason: one row per unreadable text."""
    return checked.select(*keys, F.explode(out).alias("_r")).select(*keys, "_r.*")


def observed(checked: DataFrame, name: str = "cleaning", out: str = "rejects") -> tuple[DataFrame, Observation]:
    """``checked`` with counts that Spark keeps while any result of it is computed:
    rows, rows_with_rejects, rejected_values."""
    seen = Observation(name)
    return checked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.size(out) > 0, 1)).alias("rows_with_rejects"),
        F.coalesce(F.sum(F.size(out)), F.lit(0)).alias("rejected_values")), seen
