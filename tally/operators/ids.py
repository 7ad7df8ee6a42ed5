"""Stable dense row ids without a single-partition window.

``row_number() over (order by ...)`` with no partition pulls every row into
one task.  Here equal rows are counted first (combined map-side, so a row
that repeats a billion times is one row from then on), the distinct rows are
range-partitioned and sorted on the order key and their remaining columns,
and every distinct row gets the first id of its copies: a running count
inside its partition plus the partition's offset (one row per partition, a
bounded table).  Copies are written out again behind that, long runs in
chunks that Spark deals over tasks.

The ranged distinct rows are written once as a parquet table under the
cluster's checkpoint folder (``spark.checkpoint.dir``) and read back: counts
and rows then come from the same data even if executors are lost (range
bounds are sampled, so recomputing the ranged frame could cut it
differently).

Where the order key is unique (``unique=True``) nothing is counted: a row's id is
its place in its range partition, taken as the ranged rows are written, plus the
partition's offset.  That is one range shuffle and one write.

The id equals ``row_number()`` over the order key and then all other columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

COPIES_AT_ONCE = 100_000


def with_dense_id(df: DataFrame, order_cols: Sequence[str], id_col: str = "record_id",
                  num_partitions: int | None = None, copies_at_once: int = COPIES_AT_ONCE,
                  unique: bool = False) -> DataFrame:
    """Add ``id_col`` = row_number() over ``order_cols`` (see module doc).

    ``unique`` says that no two rows are equal in ``order_cols``; if two are, their
    order is open, but ids stay dense.  Without ``num_partitions`` the range exchange uses the session's shuffle
    partition count and AQE may merge adjacent small ranges (merging keeps
    the global order, and the written table freezes the layout).
    """
    return numbered(df, order_cols, id_col, num_partitions, copies_at_once, unique)[0]


def numbered(df: DataFrame, order_cols: Sequence[str], id_col: str = "record_id", num_partitions: int | None = None,
             copies_at_once: int = COPIES_AT_ONCE, unique: bool = False) -> tuple[DataFrame, int]:
    """``with_dense_id`` and the number of rows."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if unique:
        order, rows = list(order_cols), df.withColumn("_copies", F.lit(1).cast("long"))
    else:
        order = [*order_cols, *[c for c in df.columns if c not in order_cols]]
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    by_range = (rows.repartitionByRange(num_partitions, *order) if num_partitions
                else rows.repartitionByRange(*order))
    ranged = (
        by_range
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    path = f"{folder.rstrip('/')}/tally-dense-id-{uuid.uuid4().hex}"
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_part").agg(F.sum("_copies").alias("_n"), F.max("_copies").alias("_most"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    total, most = sizes.agg(F.sum("_n"), F.max("_most")).first()
    if unique:
        place = F.col("_mono") % F.lit(1 << 33)  # the row's place in its partition
        out = ranged.join(F.broadcast(offsets), "_part").select(
            *df.columns, (F.col("_offset") + place + 1).alias(id_col))
        return out, total or 0
    inside = Window.partitionBy("_part").orderBy("_mono").rowsBetween(Window.unboundedPreceding, -1)
    first = ranged.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        F.broadcast(offsets), "_part").withColumn("_first", F.col("_offset") + F.col("_before") + 1)
    step = F.lit(copies_at_once).cast("long")
    chunk = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("_copies") - 1, step))
    first = first.withColumn("_chunk", F.explode(chunk))
    if (most or 0) > copies_at_once:
        first = first.repartition("_first", "_chunk")
    many = F.least(step, F.col("_copies") - F.col("_chunk") * step)
    ids = F.transform(F.sequence(F.lit(0).cast("long"), many - 1),
                      lambda i: F.col("_first") + F.col("_chunk") * step + i)
    return first.select(*df.columns, F.explode(ids).alias(id_col)), total or 0
