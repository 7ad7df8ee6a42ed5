"""Exact percentiles of continuous values by distributed selection.

``aggs.percentiles`` keeps a map of all distinct values of a group, which is
fine for day counts and not for amounts.  Here no task ever holds more than
``buckets`` counters per group and wanted rank:

1. One aggregate gives count, smallest and largest value per group, and so the
   wanted ranks: a percentile p of n values lies between the ranks floor and
   ceil of p * (n - 1).
2. Every pass cuts the interval that holds a wanted rank into ``buckets`` pieces
   by a scale that never decreases with the value (logarithmic while the
   interval spans more than a factor of two, linear after that), counts the
   values of each piece (combined map-side) with the piece's own smallest and
   largest value, and goes on with the piece that the rank falls into.
3. A piece with a single value, or with at most ``buckets`` rows, needs no more
   passes: its different values are counted, and running counts give the value.

Amounts take two or three passes; doubles of any magnitude at most seven.  A pass
reads the rows once and shuffles counters, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import ColumnOrName, _c
from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast

BUCKETS = 4096
# Every double except 0 has a binary logarithm above -1075.
LOG_SHIFT = 1100.0


def _written(df: DataFrame) -> DataFrame:
    """A small table of a pass, written so that later passes start from files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tally-quantiles-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _log_scale(x: Column) -> Column:
    """Never decreases with x; 0 at 0, and ±1 apart for a factor of two."""
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (F.log2(F.abs(x)) + F.lit(LOG_SHIFT)))


def _bucket(x: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Piece of [lo, hi] that x lies in, 0 to buckets - 1; never decreases with x.
    Infinities and NaN (above all other values) have pieces of their own."""
    log = _log_scale(hi) - _log_scale(lo) > 1
    place = lambda s: (s(x) - s(lo)) / (s(hi) - s(lo))
    share = F.when(log, place(_log_scale)).when(hi > lo, place(lambda v: v)).otherwise(F.lit(0.0))
    inside = F.least(F.floor(share * F.lit(float(buckets))), F.lit(buckets - 1)).cast("int")
    top = F.lit(float("inf"))
    return (F.when(F.isnan(x), buckets + 1).when(x == top, buckets).when(x == -top, -1).otherwise(inside))


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def _intervals(values: DataFrame, by: list[str], ranks: Column) -> DataFrame:
    """One row per group and wanted rank: the interval of all its values."""
    v = F.col("_v")
    whole = values.groupBy(*by).agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                    F.min(_finite(v)).alias("_flo"), F.max(_finite(v)).alias("_fhi"))
    return whole.where("_n > 0").withColumn("_rank", F.explode(ranks)).select(
        *by, "_rank", "_lo", "_hi", "_flo", "_fhi", F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_rows"))


def _met(values: DataFrame, asked: DataFrame, by: list[str]) -> DataFrame:
    """The values inside the interval of each wanted rank of their group."""
    asked = bounded_broadcast(asked.groupBy(*[F.col(c).alias(f"_k_{c}") for c in by]).agg(
        F.collect_list(F.struct("_rank", "_lo", "_hi", "_flo", "_fhi", "_before")).alias("_asked")))
    cond = F.lit(True)
    for c in by:
        cond = cond & values[c].eqNullSafe(asked[f"_k_{c}"])
    joined = values.join(asked, cond) if by else values.join(asked)
    hit = F.filter("_asked", lambda a: (F.col("_v") >= a["_lo"]) & (F.col("_v") <= a["_hi"]))
    return joined.select(*by, "_v", F.explode(hit).alias("_a")).select(*by, "_v", "_a.*")


def _narrowed(values: DataFrame, asked: DataFrame, by: list[str], buckets: int) -> DataFrame:
    """``asked`` with each interval cut down to the piece that holds its rank."""
    v = F.col("_v")
    counted = _met(values, asked, by).groupBy(
        *by, "_rank", "_before", _bucket(v, F.col("_flo"), F.col("_fhi"), buckets).alias("_piece")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    w = Window.partitionBy(*by, "_rank").orderBy("_piece")  # at most buckets + 3 pieces
    upto = F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counted.withColumn("_upto", F.col("_before") + upto).where(
        (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_rows")))
    return found.select(*by, "_rank", "_lo", "_hi", _finite(F.col("_lo")).alias("_flo"), _finite(F.col("_hi")).alias("_fhi"),
                        (F.col("_upto") - F.col("_rows")).alias("_before"), "_rows")


def ranked_values(values: DataFrame, by: list[str], ranks: Column, buckets: int = BUCKETS) -> DataFrame:
    """by, _rank, _value: the value of every wanted rank (from 0) of column ``_v``.
    ``ranks`` is an array over ``_n``, the group's number of values."""
    asked, parts = _written(_intervals(values, by, ranks)), []
    while True:
        done = (F.col("_lo") == F.col("_hi"))
        few = ~done & (F.col("_rows") <= buckets)
        parts.append(asked.where(done).select(*by, "_rank", F.col("_lo").alias("_value")))
        if not asked.where(few).isEmpty():
            counts = _met(values, asked.where(few), by).groupBy(*by, "_rank", "_before", "_v").agg(
                F.count(F.lit(1)).alias("_rows"))
            w = Window.partitionBy(*by, "_rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            parts.append(counts.withColumn("_upto", F.col("_before") + F.sum("_rows").over(w)).where(
                (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_rows"))).select(
                *by, "_rank", F.col("_v").alias("_value")))
        rest = asked.where(~done & ~few)
        if rest.isEmpty():
            break
        asked = _written(_narrowed(values, rest, by, buckets))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exact_percentiles(df: DataFrame, by: Sequence[str], value: ColumnOrName, ps: Sequence[float],
                      names: Sequence[str], digits: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``percentile_cont`` of a numeric column per group, as ``aggs.percentiles``
    gives it, for any number of distinct values.

    NULL values do not count; a group without values gives NULLs, as does a table
    without rows if there is no ``by``.  NULL keys are a group.  Values are taken
    as doubles; NaN is above all others.  ``digits`` rounds the results.
    """
    by, spread = list(by), [float(p) for p in ps]
    values = df.select(*by, _c(value).cast("double").alias("_v"))
    values = values.withColumn("_v", F.col("_v") + F.lit(0.0))  # -0.0 is 0.0
    at = lambda p: F.lit(p) * (F.col("_n") - 1)
    ranks = F.array_distinct(F.array(*[f(at(p)).cast("long") for p in spread for f in (F.floor, F.ceil)]))
    found = ranked_values(values.where("_v is not null"), by, ranks, buckets)
    counts = values.groupBy(*by).agg(F.count("_v").alias("_n"))
    table = _written(found).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_m"))
    side = table.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_m")
    cond = F.lit(True)
    for c in by:
        cond = cond & counts[c].eqNullSafe(side[f"_k_{c}"])
    met = counts.join(side, cond, "left") if by else counts.join(side, how="left", on=F.lit(True))

    def between(p: float) -> Column:
        low, high = F.floor(at(p)).cast("long"), F.ceil(at(p)).cast("long")
        a, b = F.try_element_at("_m", low), F.try_element_at("_m", high)
        mixed = (high - at(p)) * a + (at(p) - low) * b
        got = F.when(a == b, a).otherwise(mixed)
        return got if digits is None else F.round(got, digits)
    return met.select(*by, *[between(p).alias(n) for p, n in zip(spread, names)])
