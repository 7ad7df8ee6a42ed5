"""Comma-list operators: lateral explode (J11) and ordered string
aggregation (A18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import list_items
from ..functions.semantics import ColumnOrName, _c
from .ids import with_dense_id

PIECE_ROWS = 100_000
# A string of Spark holds less than 2^31 bytes.
MAX_CHARS = 500_000_000


def explode_list(df: DataFrame, list_col: str, out: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per trimmed item of a comma-separated text column.

    Rows whose text is blank produce no row (the source guards the split
    with ``<> ''``); empty items of other rows are rows.  ``explode`` is a
    narrow generator: no shuffle.
    """
    return df.select(*keep, F.explode(list_items(F.col(list_col))).alias(out))


def sorted_text_list(values: ColumnOrName, sep: str = ",") -> Column:
    """Aggregate: the group's non-NULL values sorted and joined by ``sep``.

    Meant for small groups (the items of one order); the list is the
    output, so its size is the group's result size.
    """
    return F.array_join(F.array_sort(F.collect_list(_c(values))), sep)


def string_agg(df: DataFrame, by: Sequence[str], value: str, out: str, sep: str = ",",
               piece_rows: int = PIECE_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """STRING_AGG(value, sep) in the order of ``value``, for groups of any number
    of rows: one row per group, NULL values left out (a group with no other
    values has no row).

    The rows are numbered in (by, value) order over range partitions and joined
    in pieces of at most ``piece_rows`` rows, so a hot group is split over
    tasks; only the finished pieces of a group meet.  The text of a group is one
    value by definition: more than ``max_chars`` characters raise an error that
    says so, before the pieces are joined.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("string").alias("_v"))
    numbered = with_dense_id(rows, [*by, "_v"], "_rid").withColumn(
        "_piece", F.call_function("div", F.col("_rid") - 1, F.lit(piece_rows)))
    pieces = numbered.groupBy(*by, "_piece").agg(sorted_text_list("_v", sep).alias("_text"))
    sized = pieces.groupBy(*by).agg(F.sum(F.length("_text") + F.lit(len(sep))).alias("_chars"),
                                    F.array_sort(F.collect_list(F.struct("_piece", "_text"))).alias("_all"))
    joined = F.array_join(F.transform("_all", lambda p: p["_text"]), sep)
    too_long = F.raise_error(F.concat(F.lit(f"string_agg: more than {max_chars} characters in a group: "), F.col("_chars")))
    return sized.select(*by, F.when(F.col("_chars") - len(sep) > max_chars, too_long.cast("string")).otherwise(joined).alias(out))
