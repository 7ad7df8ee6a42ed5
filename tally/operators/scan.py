"""Running sums and previous values over raw rows (W7-W9), for any skew.

A window per key sends all rows of a key to one task.  Here the rows get a
global dense position in (key, order) order (``ids.numbered``: range partitions,
so a hot key spreads over many), and windows run over buckets of a fixed number
of positions.  What a bucket hands on is one row: the key of its last row, that
key's sum inside the bucket and the last row's values.  Sums over these rows,
one per bucket, are the offsets of the buckets that go on with the same key.

Three steps, therefore: sums inside buckets, a scan over one row per bucket,
and the offsets joined back by bucket.  No window holds more than
``rows_per_bucket`` rows of the input, nor more than (rows of a key /
``rows_per_bucket``) bucket rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ids import numbered

ROWS_PER_BUCKET = 1_000_000
# Bucket rows that are broadcast at most: about 100 bytes each.
BROADCAST_BUCKETS = 100_000


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for x, y in pairs:
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def _add(a: Column, b: Column) -> Column:
    """a + b where NULL is no value: NULL only if both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running_in_order(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
                     sums: Mapping[str, str] | None = None, previous: Mapping[str, str] | None = None,
                     frame: str = "rows", unique: bool = False,
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` with running sums and previous values per ``key`` in ``order``.

    ``sums`` maps an output column to the column summed: ``sum(c) over (partition
    by key order by order)`` with a ROWS frame (``frame="rows"``), or with the
    default RANGE frame, in which rows equal in ``order`` count together
    (``frame="range"``).  ``previous`` maps an output column to the column of the
    row before: ``lag(c, 1)``; it needs the ROWS frame.

    NULL keys are a key, NULL orders come first, NULL values add nothing, and a
    sum without any value is NULL, as in SQL.  Rows equal in key and order are
    taken in the order of their other columns; ``unique`` says that there are
    none, which saves a shuffle.  Whole numbers and decimals add up exactly;
    doubles in an order of their own.
    """
    key, order, sums, previous = _list(key), _list(order), dict(sums or {}), dict(previous or {})
    if frame == "range":
        if previous:
            raise ValueError("a previous value needs the rows frame")
        return _with_peers(df, key, order, sums, rows_per_bucket)
    if frame != "rows":
        raise ValueError("frame must be 'rows' or 'range'")
    rows, n = numbered(df, [*key, *order], "_rid", unique=unique)
    rows = rows.withColumn("_b", F.call_function("div", F.col("_rid") - 1, F.lit(rows_per_bucket)))
    # a key's rows inside a bucket: at most rows_per_bucket, whatever the key
    inside = Window.partitionBy("_b", *key).orderBy("_rid")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = {f"_p_{o}": F.col(c) for o, c in previous.items()}
    rows = rows.select(
        "*", *[F.sum(c).over(upto).alias(f"_s_{o}") for o, c in sums.items()],
        *([F.lag(F.struct(*[c.alias(o) for o, c in before.items()])).over(inside).alias("_before")] if previous else []))
    handed = _handed_on(rows, key, sums, before, rows_per_bucket)
    if n // rows_per_bucket <= BROADCAST_BUCKETS:
        handed = F.broadcast(handed)
    met = rows.join(handed, _same(rows, handed, [("_b", "_next"), *[(k, f"_k_{k}") for k in key]]), "left")
    lag = lambda o: F.when(F.col("_before").isNull(), F.col(f"_h_p_{o}")).otherwise(F.col("_before")[f"_p_{o}"])
    return met.select(
        *[rows[c] for c in df.columns],
        *[_add(F.col(f"_s_{o}"), F.col(f"_h_s_{o}")).alias(o) for o in sums],
        *[lag(o).alias(o) for o in previous])


def _handed_on(rows: DataFrame, key: list[str], sums: Mapping[str, str], before: Mapping[str, Column],
               rows_per_bucket: int) -> DataFrame:
    """One row per full bucket: what the next bucket adds to the rows of the same key."""
    last = rows.where(F.col("_rid") % rows_per_bucket == 0)
    w = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return last.select(
        (F.col("_b") + 1).alias("_next"), *[F.col(k).alias(f"_k_{k}") for k in key],
        *[F.sum(f"_s_{o}").over(w).alias(f"_h_s_{o}") for o in sums],
        *[c.alias(f"_h{o}") for o, c in before.items()])


def _with_peers(df: DataFrame, key: list[str], order: list[str], sums: Mapping[str, str],
                rows_per_bucket: int) -> DataFrame:
    """The RANGE frame: rows equal in key and order are first added up (combined
    map-side), the totals are scanned, and every row takes its total's sum."""
    names = {f"_t_{i}": c for i, c in enumerate(dict.fromkeys(sums.values()))}
    by_column = {c: t for t, c in names.items()}
    totals = df.groupBy(*key, *order).agg(*[F.sum(c).alias(t) for t, c in names.items()])
    scanned = running_in_order(totals, key, order, {o: by_column[c] for o, c in sums.items()},
                               unique=True, rows_per_bucket=rows_per_bucket)
    side = scanned.select(*[F.col(c).alias(f"_k_{c}") for c in [*key, *order]], *sums)
    return df.join(side, _same(df, side, [(c, f"_k_{c}") for c in [*key, *order]])).select(
        *[df[c] for c in df.columns], *sums)
