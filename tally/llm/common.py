"""Helpers shared by the corpus operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..session import ensure_checkpoint_dir

# White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"\x20\x09-\x0D"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the session's shared checkpoint folder and read
    it back: later plans start from files that survive a lost executor, and
    Catalyst knows their size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text with null counted as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_mark() -> Column:
    """64-bit digest of the text.  With ``doc_id`` it names a row in joins of a
    corpus with its decisions; rows equal in both are repeats of one row."""
    return F.xxhash64(text_of())


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast when the size (of written files) is under 32 MB; beyond that
    Spark joins by shuffle."""
    return bounded_broadcast(df)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until ``df`` has no such column (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def keep_rows(docs: DataFrame, decisions: DataFrame, label: str) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``decisions`` (doc_id, row_mark,
    kept) keeps; of rows equal in doc_id and text at most one.

    Only rows to drop, or kept rows that repeat, are written as marks; the
    corpus meets them in one join, broadcast when the marks are small."""
    cols = docs.columns
    row, own_id, mark, kept, rows = free_names(docs, "_t_row", "_t_id", "_t_mark", "_t_kept", "_t_rows")
    marks = materialise(
        decisions.groupBy(F.col("doc_id").alias(own_id), F.col("row_mark").alias(mark)).agg(
            F.max("kept").alias(kept), F.count(F.lit(1)).alias(rows)).where(
            ~F.col(kept) | (F.col(rows) > 1)), f"marks-{label}")
    marked = docs.withColumn(row, row_mark())
    side = small_side(marks)
    joined = marked.join(side, null_safe(marked, side, [("doc_id", own_id), (row, mark)]), "left")
    same = [F.col(f"`{c}`") for c in cols]
    single = joined.where(F.col(mark).isNull()).select(*same)
    if marks.where(kept).isEmpty():
        return single
    once = joined.where(F.col(kept)).dropDuplicates([own_id, mark]).select(*same)
    return single.unionByName(once)


def publish(spark: SparkSession, name: str, blob: bytes) -> str:
    """Write a small file to the shared folder through Spark's file systems;
    returns its path, for ``SparkContext.addFile`` or ``addPyFile``."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), name)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(blob))
    finally:
        out.close()
    return path.toString()


def publish_all(spark: SparkSession, names: list[str], parts: Iterable) -> list[str]:
    """Like ``publish`` for files of any size that grow together: every row of
    ``parts`` has the next bytes of each file, and only one row is held."""
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), name) for name in names]
    outs = [p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p) for p in paths]
    try:
        for row in parts:
            for out, blob in zip(outs, row):
                out.write(bytearray(blob))
    finally:
        for out in outs:
            out.close()
    return [p.toString() for p in paths]


_shipped: set[str] = set()


# A batch of documents in a Python worker, and its copy in the JVM, stay small
# whatever the texts' lengths.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), so that
    functions run there import it whatever the executors' paths are, and bound
    the session's Arrow batches."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(top)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(publish(spark, f"tally-{uuid.uuid4().hex}.zip", buffer.getvalue()))
    _shipped.add(sc.applicationId)
