"""Window-style operators, written to survive hot keys.

A plain ``Window.partitionBy(key)`` sends every row of one key to one task.
When one customer holds a third of all rows that task holds a third of the
data.  The operators here therefore:

* answer "first / last row per key" with aggregates (``min_by`` / ``max_by``
  over a struct order key), which combine map-side before the shuffle;
* answer "rank = 1 with ties" by joining the rows with their key's best value
  (an aggregate), so tied rows of a hot key stay where the join puts them;
* compute full ranks from counts per (key, order value): only one small row
  per (key, order value) goes through a window partitioned by key;
* answer "next row" (``next_in_order``) on globally numbered rows: every
  window partition is a fixed-size bucket of positions, whatever the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Cols = Sequence[str]


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per(df: DataFrame, by: Cols | str, order: Cols | str, value_cols: Cols | str,
              last: bool = False) -> DataFrame:
    """Value columns of the first (or last) row per group under a total order.

    ``order`` must make rows unique within a group for a deterministic
    answer (add a tie-break key).  Implemented as one aggregate:
    ``min_by(struct(values), struct(order))`` combines partially per map
    task, so a hot group never travels to one task as raw rows.
    """
    by, order, value_cols = _as_list(by), _as_list(order), _as_list(value_cols)
    pick = F.max_by if last else F.min_by
    picked = pick(F.struct(*value_cols), F.struct(*order)).alias("_picked")
    out = df.groupBy(*by).agg(picked)
    return out.select(*by, *[F.col(f"_picked.{c}").alias(c) for c in value_cols])


def rank_top(df: DataFrame, by: Cols | str, order_col: str, largest: bool = False) -> DataFrame:
    """Rows whose rank within ``by`` is 1 (ties kept): those that have their
    key's smallest (or largest) ``order_col``.

    The best value per key is an aggregate combined map-side; the rows meet
    it in an equi-join that adaptive execution can split for a hot key."""
    by = _as_list(by)
    best = (F.max if largest else F.min)(order_col).alias("_best")
    side = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in by]).agg(best)
    cond = F.col(order_col).eqNullSafe(F.col("_best"))
    for k in by:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(side, cond, "left_semi")


def rank_within(df: DataFrame, by: Cols | str, order_col: str,
                rank_col: str = "rank") -> DataFrame:
    """``rank() over (partition by by order by order_col)`` for every row.

    rank = 1 + number of rows of the group with a smaller ``order_col``.
    That count comes from a per-(group, order value) aggregate (map-side
    combined), a running sum over that small aggregate, and an equi-join
    back on (group, order value).  The big side is shuffled once, by
    (group, order value), so a hot group is spread over its order values.
    NULLs order first and keys are matched null-safe.
    """
    ranks = ranks_of(df, by, order_col, rank_col)
    return join_ranks(df, ranks, [*_as_list(by), order_col], rank_col)


def ranks_of(df: DataFrame, by: Cols | str, order_col: str, rank_col: str = "rank") -> DataFrame:
    """(by, order_col, rank): the ranks of ``rank_within``, one row per order value."""
    by = _as_list(by)
    counts = df.groupBy(*by, order_col).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*by).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(*by, order_col,
                         (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).alias(rank_col))


def join_ranks(df: DataFrame, ranks: DataFrame, keys: Cols, rank_col: str) -> DataFrame:
    """``df`` with ``rank_col`` of the matching row of ``ranks`` (null-safe keys)."""
    side = ranks.select(*[F.col(k).alias(f"_r_{k}") for k in keys], rank_col)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(side, cond, "left").select(*df.columns, rank_col)


def next_in_order(df: DataFrame, key: Cols | str, order: Cols | str, value_cols: Cols | str,
                  prefix: str = "next_", rows_per_bucket: int = 1_000_000, unique: bool = False) -> DataFrame:
    """``lead(value, 1) over (partition by key order by order)`` for any skew.

    The rows get a global dense position in (key, order) order
    (``with_dense_id``: sampled range partitions, so no key is kept whole in
    one task).  ``lead`` then runs inside fixed-size buckets of positions
    (at most ``rows_per_bucket`` rows per window partition, whatever the key
    distribution); the last row of a bucket takes the first row of the next
    bucket through a join with one row per bucket.  A next row that belongs
    to another key gives NULL.  ``order`` must be unique within a key.

    NULL order values come first.  Costs one range shuffle, one write of the
    ranged rows to the checkpoint folder and one shuffle by bucket, and without
    ``unique`` (no two rows equal in key and order) one count of equal rows.
    """
    from .ids import with_dense_id  # local import: ids imports session helpers

    key, order, value_cols = _as_list(key), _as_list(order), _as_list(value_cols)
    carried = [*key, *value_cols]
    r = with_dense_id(df, [*key, *order], "_rid", unique=unique)
    r = r.withColumn("_b", F.call_function("div", F.col("_rid") - 1, F.lit(rows_per_bucket)))
    w = Window.partitionBy("_b").orderBy("_rid")
    within = r.withColumn("_nx", F.lead(F.struct(*carried), 1).over(w))
    heads = r.where((F.col("_rid") - 1) % rows_per_bucket == 0).select(
        (F.col("_b") - 1).alias("_b"), F.struct(*carried).alias("_head"))
    j = within.join(heads, "_b", "left")
    nxt = F.when(F.col("_nx").isNull(), F.col("_head")).otherwise(F.col("_nx"))
    same_key = F.lit(True)
    for k in key:
        same_key = same_key & nxt[k].eqNullSafe(F.col(k))
    return j.select(
        *df.columns,
        *[F.when(nxt.isNotNull() & same_key, nxt[c]).alias(f"{prefix}{c}") for c in value_cols])


def running_sum(df: DataFrame, by: Cols | str, order: str, value: str,
                out: str, frame: str = "rows") -> DataFrame:
    """Running total per group (W8 rows frame / W9 default range frame).

    Meant for frames that are already aggregated to one row per (group,
    period): the window then holds at most one row per period per group.  For
    raw rows see ``scan.running_in_order``.
    """
    by = _as_list(by)
    w = Window.partitionBy(*by).orderBy(order)
    if frame == "rows":
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    elif frame != "range":
        raise ValueError("frame must be 'rows' or 'range'")
    return df.withColumn(out, F.sum(value).over(w))


def previous_value(df: DataFrame, by: Cols | str, order: str, value: str,
                   out: str) -> DataFrame:
    """``lag(value, 1)`` per group (W7), for per-period aggregated frames."""
    by = _as_list(by)
    return df.withColumn(out, F.lag(value, 1).over(Window.partitionBy(*by).orderBy(order)))
