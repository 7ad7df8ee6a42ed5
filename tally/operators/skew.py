"""Joins with a hot key (J1, J2, J12), without relying on adaptive execution.

Heavy hitters are found by Spark's mergeable frequent-items sketch
(``approx_top_k``) over a hash of the key columns: one pass with one small state
per task.  Rows of hot keys get a salt, the other side's rows of those keys are
repeated once per salt, and the two meet on (key, salt); all other rows join
plainly.  A hash shared by chance only means that a cold key is salted too.

If a hot key is hot on both sides (a fan-out), an inner join salts both: each
row of one side meets a row of the other in exactly one cell of the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import parts_by_size

# Keys with at least this share of the rows are hot; at most HOT_KEYS are taken.
HOT_SHARE = 0.005
HOT_KEYS = 200          # = 1 / HOT_SHARE: no more keys can have that share
SKETCH_ITEMS = 10_000   # items a sketch tracks; its error is below rows / SKETCH_ITEMS
SALTS = 32
GRID_SALTS = 8          # salts of the second side when both are hot


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, limit: int = HOT_KEYS) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows: at most ``limit`` numbers."""
    found = df.select(_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {limit}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"])


def _salted(df: DataFrame, hot: Column, own: str, salts: int, other: str, copies: int) -> DataFrame:
    """Hot rows with a salt of their own (their place in the input partition) and
    one copy for each of the other side's salts."""
    rows = df.where(hot).withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, parts: int | None) -> DataFrame:
    if parts:
        left, right = left.repartition(parts, *keys), right.repartition(parts, *keys)
    return left.join(right, list(keys), how)


def sized_join(left: DataFrame, right: DataFrame, keys: Sequence[str], task_bytes: int | None = None) -> DataFrame:
    """``left.join(right, keys)`` of two scans, in tasks of about ``task_bytes`` (``joins.TASK_BYTES``) of them.

    Sizes are those of the tables, so small ones join as Spark plans it.  A given
    number of partitions keeps adaptive execution from splitting a hot key, so keys
    that are hot on the left are spread by ``hot_join``."""
    parts = parts_by_size(left, right, task_bytes)
    return hot_join(left, right, keys, parts=parts) if parts else left.join(right, list(keys))


def hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", share: float = HOT_SHARE,
             salts: int = SALTS, parts: int | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` inner, left, left_semi or
    left_anti, where keys may be hot on the left (for inner joins on both sides).

    The result has the rows and columns of the plain join.  NULL keys match
    nothing, as there; many of them count as a hot key and are spread as well.
    A row's salt is its place in its input partition, so inputs that come out of
    a shuffle whose rows may arrive in another order should be written first.
    ``parts`` is the number of partitions of each join; without it Spark chooses.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("how must be inner, left, left_semi or left_anti")
    keys = list(keys)
    hot = hot_hashes(left, keys, share)
    if not hot:
        return _meet(left, right, keys, how, parts)
    both = how == "inner" and bool(set(hot) & set(hot_hashes(right, keys, share)))
    grid = GRID_SALTS if both else 1
    is_hot = _hash(keys).isin(hot)
    a = _salted(left, is_hot, "_salt_l", salts, "_salt_r", grid)
    b = _salted(right, is_hot, "_salt_r", grid, "_salt_l", salts)
    spread = _meet(a, b, [*keys, "_salt_l", "_salt_r"], how, parts).drop("_salt_l", "_salt_r")
    plain = _meet(left.where(~is_hot), right.where(~is_hot), keys, how, parts)
    return plain.unionByName(spread)
