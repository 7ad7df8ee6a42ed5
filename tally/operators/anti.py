"""NOT IN as relations, null-aware.

``x NOT IN (select ...)`` keeps a row only if the comparison is true for every
value: one NULL among the values drops every row, and a NULL on the left is kept
only when there are no values.  Both facts are small aggregates; the rest is a
left anti join on equality, which Spark plans as a hash or sort-merge join
(its own null-aware anti join is a broadcast of the whole right side).

``bloom_bits`` builds a Bloom filter of the values first: a fixed number of bits,
whatever the input, kept as one array.  Rows that it rules out skip the join and
its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOOM_HASHES = 4
BLOOM_BITS = 1 << 20     # 128 KB


def _places(columns: Sequence[Column], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *columns), F.lit(bits)) for i in range(BLOOM_HASHES)]


def bloom_filter(df: DataFrame, columns: Sequence[str], bits: int = BLOOM_BITS) -> DataFrame:
    """One row with ``bloom``: the filter over ``columns`` as an array of bits / 64 longs."""
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    places = df.select(F.explode(F.array(*_places([F.col(c) for c in columns], bits))).alias("p"))
    words = places.groupBy(F.call_function("div", F.col("p"), F.lit(64)).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
    held = words.agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    return held.select(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bits // 64 - 1).cast("long")),
                                   lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("bloom"))


def might_contain(bloom: Column, columns: Sequence[Column], bits: int = BLOOM_BITS) -> Column:
    """False only for rows that are surely not in the filter."""
    out = F.lit(True)
    for p in _places(columns, bits):
        word = F.element_at(bloom, (F.call_function("div", p, F.lit(64)) + 1).cast("int"))
        out = out & (F.call_function("shiftrightunsigned", word, (p % 64).cast("int")) % 2 != 0)
    return out


def _anti(df: DataFrame, excluded: DataFrame, columns: Sequence[str], bloom_bits: int | None) -> DataFrame:
    """Rows of ``df`` without an equal row (no NULLs) in ``excluded``, by ``columns``."""
    if bloom_bits is None:
        return df.join(excluded, list(columns), "left_anti")
    bloom = bloom_filter(excluded, columns, bloom_bits).scalar()
    may = might_contain(bloom, [F.col(c) for c in columns], bloom_bits)
    return df.where(~may).unionByName(df.where(may).join(excluded, list(columns), "left_anti"))


def not_in(df: DataFrame, column: str, excluded: DataFrame, excluded_column: str | None = None,
           bloom_bits: int | None = None) -> DataFrame:
    """``df`` where ``column NOT IN (select excluded_column from excluded)``."""
    values = excluded.select(F.col(excluded_column or column).alias(column))
    held = values.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))).scalar()
    kept = df.where((held["n"] == 0) | ((held["nulls"] == 0) & F.col(column).isNotNull()))
    return _anti(kept, values.where(F.col(column).isNotNull()), [column], bloom_bits)


def drop_excluded(df: DataFrame, excluded: DataFrame, keys: Sequence[str], column: str,
                  bloom_bits: int | None = None) -> DataFrame:
    """``df`` where ``column NOT IN (select column from excluded e where e.keys = df.keys)``.

    Per group of ``keys``: a NULL among its values drops the whole group, a NULL
    in ``df`` is kept only in a group without values.  NULL keys equal nothing, so
    such rows stay.  ``excluded`` has the columns ``keys`` and ``column``."""
    keys = list(keys)
    values = excluded.select(*keys, column)
    null_groups = values.where(F.col(column).isNull()).select(*keys).distinct()
    known = _anti(df.where(F.col(column).isNotNull()), values.where(F.col(column).isNotNull()), [*keys, column], bloom_bits)
    known = known.join(null_groups, keys, "left_anti")
    # rows with a NULL equal no value: they need only the groups that have values
    unknown = df.where(F.col(column).isNull()).join(values.select(*keys).distinct(), keys, "left_anti")
    return known.unionByName(unknown).select(*df.columns)
