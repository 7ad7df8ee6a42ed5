"""Aggregate building blocks.

All of these are built-in Spark aggregates, so they run with partial
(map-side) aggregation.  Several conditional distinct counts of one key are
per-key flags that are then summed (``flags_per``): one pass over the rows,
without the row copies of an ``Expand``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import ColumnOrName, _c


def count_if(cond: Column, value: ColumnOrName | None = None) -> Column:
    """COUNT(CASE WHEN cond THEN value END) -- NULL values are not counted."""
    return F.count(F.when(cond, F.lit(1) if value is None else _c(value)))


def sum_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def flags_per(df: DataFrame, key: str, flags: Mapping[str, Column], total: str) -> DataFrame:
    """COUNT(DISTINCT CASE WHEN cond THEN key END) for every named condition, and
    COUNT(DISTINCT key) as ``total``: one flag per key and condition, then sums."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()])
    return per.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags],
                   F.count(key).alias(total))


def signed_amount(type_col: ColumnOrName, amount_col: ColumnOrName,
                  credit_pattern: str = "%deposit") -> Column:
    """+amount for credit rows (case-insensitive LIKE), -amount otherwise."""
    amt = _c(amount_col)
    return F.when(_c(type_col).ilike(credit_pattern), amt).otherwise(-amt)


def net_amount(type_col: ColumnOrName, amount_col: ColumnOrName,
               credit_pattern: str = "%deposit") -> Column:
    """Sum of credits minus everything else."""
    return F.sum(signed_amount(type_col, amount_col, credit_pattern))


def percentiles(df: DataFrame, by: Sequence[str], value: ColumnOrName,
                ps: Sequence[float], names: Sequence[str], digits: int | None = None) -> DataFrame:
    """Exact interpolated percentiles per group (PERCENTILE_CONT, A19/W11).

    Spark's exact ``percentile`` keeps a value->count map per group as its
    partial buffer, so memory grows with the number of distinct values, not
    with the number of rows; for day counts that is bounded by the calendar.
    ``digits`` rounds the results, for comparisons between engines, whose
    interpolations differ in the last binary digit; by default nothing is rounded.
    """
    arr = F.percentile(_c(value), F.array(*[F.lit(float(p)) for p in ps])).alias("_p")
    out = df.groupBy(*by).agg(arr)
    value_of = lambda i: F.col("_p")[i] if digits is None else F.round(F.col("_p")[i], digits)
    return out.select(*by, *[value_of(i).alias(n) for i, n in enumerate(names)])


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First k rows under ``order`` (TOP k with ORDER BY); planned as a
    TakeOrderedAndProject: each task keeps k rows, the driver merges k x
    tasks rows.  Give a total order for a deterministic result."""
    return df.orderBy(*order).limit(k)
