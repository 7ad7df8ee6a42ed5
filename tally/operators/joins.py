"""Join operators.

Physical join choice is left to Catalyst and AQE (broadcast when a side's
statistics are under ``spark.sql.autoBroadcastJoinThreshold``, sort-merge
otherwise, skew-join splitting at runtime).  ``bounded_broadcast`` is used
only for dimensions whose size is fixed by construction (literal tables,
the 25-row nation table, per-pizza recipe arrays) and still checks the
plan's size estimate before hinting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (None when unavailable)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # Spark Connect or unexpected plan: no estimate
        return None
    # py4j hands a Scala BigInt over as a Python int (or as a JVM object)
    return int(size) if isinstance(size, int) else int(str(size.toString()))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its estimated size is at most ``max_bytes``;
    otherwise ``df`` unchanged, leaving the choice (sort-merge) to Spark."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


# Stored bytes (both sides, the columns read) that one task of a large join takes.
TASK_BYTES = 2 * 1024 * 1024


def parts_by_size(left: DataFrame, right: DataFrame, task_bytes: int | None = None) -> int | None:
    """Partitions for a join of two scans in which a task takes about ``task_bytes``
    (``TASK_BYTES`` without).

    Spark merges shuffle partitions until there is one for every core, so what a task
    sorts and counts grows with the tables; a number of partitions that follows from
    the tables' size keeps it constant.  None leaves the choice to Spark: a side that
    it broadcasts, a size it does not know, or no more partitions than cores."""
    sizes = estimated_bytes(left), estimated_bytes(right)
    if None in sizes or max(sizes) >= 1 << 50:
        return None
    spark = left.sparkSession
    if min(sizes) <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return None
    parts = -(-sum(sizes) // (task_bytes or TASK_BYTES))
    return parts if parts > spark.sparkContext.defaultParallelism else None


def flag_membership(facts: DataFrame, members: DataFrame, key: str, fact_date: str,
                    member_date: str, out: str = "member") -> DataFrame:
    """'Y' when the key has a member row dated on or before the fact date,
    else 'N' (non-members and not-yet-members both end as 'N').

    The existence test over all member rows of a key is the same as
    comparing with the key's earliest member date, so members are first
    reduced to one row per key (a map-side combined aggregate) and joined
    once.  NULL keys in ``members`` never match, which gives the same flag
    as the null-aware NOT IN / EXISTS form.
    """
    first_join = members.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(member_date).alias("_first_member_date"))
    joined = facts.join(first_join, key, "left")
    flag = F.when(F.col("_first_member_date") <= F.col(fact_date), F.lit("Y")).otherwise(F.lit("N"))
    return joined.withColumn(out, flag).drop("_first_member_date")


def gaps_at_least(starts: DataFrame, targets: DataFrame, key: str, day: str,
                  cuts: Sequence[int]) -> DataFrame:
    """Per cut c: the number of (start, target) pairs of the same key with
    ``target_day - start_day >= c``, and the sum of those gaps.

    This is a range join answered without pairs.  Each target day becomes one
    query point per cut at ``target_day - c``; the start days and the query
    points of a key are ordered together, and running sums over the start
    days give, at each query point, how many start days (and their day sum)
    lie at or before it.  A key contributes (#distinct start days + #cuts x
    #distinct target days) rows to its window, which is linear and bounded by
    the calendar, never the product of the two sides.

    ``starts`` / ``targets``: (key, day) rows, one per event (duplicates count);
    rows without a day have no gap and are left out.
    Returns (cut, pairs, gap_sum); gap sums are decimal(38,0).
    """
    dec = "decimal(38,0)"
    epoch = F.lit("1970-01-01").cast("date")
    starts, targets = starts.where(F.col(day).isNotNull()), targets.where(F.col(day).isNotNull())
    a = (starts.select(key, F.datediff(F.col(day), epoch).alias("_d"))
         .groupBy(key, "_d").agg(F.count(F.lit(1)).cast(dec).alias("_wa")))
    b = (targets.select(key, F.datediff(F.col(day), epoch).alias("_b"))
         .groupBy(key, "_b").agg(F.count(F.lit(1)).cast(dec).alias("_wb")))
    cut_arr = F.array(*[F.lit(int(c)) for c in cuts])
    q = b.select(key, "_b", "_wb", F.explode(cut_arr).alias("_cut"))
    zero = F.lit(0).cast(dec)
    a_rows = a.select(key, "_d", F.lit(0).alias("_ord"), "_wa",
                      (F.col("_wa") * F.col("_d")).cast(dec).alias("_sa"),
                      F.lit(None).cast("int").alias("_cut"), zero.alias("_wb"),
                      F.lit(None).cast("int").alias("_b"))
    q_rows = q.select(key, (F.col("_b") - F.col("_cut")).alias("_d"), F.lit(1).alias("_ord"),
                      zero.alias("_wa"), zero.alias("_sa"), "_cut", "_wb", "_b")
    w = (Window.partitionBy(key).orderBy("_d", "_ord")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = a_rows.unionByName(q_rows).select(
        "_ord", "_cut", "_wb", "_b",
        F.sum("_wa").over(w).alias("_f"), F.sum("_sa").over(w).alias("_g"))
    hits = run.where(F.col("_ord") == 1)
    return hits.groupBy(F.col("_cut").alias("cut")).agg(
        F.sum(F.col("_wb") * F.col("_f")).cast(dec).alias("pairs"),
        F.sum(F.col("_wb") * (F.col("_b") * F.col("_f") - F.col("_g"))).cast(dec).alias("gap_sum"))
