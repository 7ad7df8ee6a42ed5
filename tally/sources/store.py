"""Stored tables with published batches.

A table is a folder: ``data/<batch>`` holds the Parquet files of one write, and
``log/<number>-<append|replace>-<batch>`` is an empty marker that publishes it.
A write first stages its files and then creates the marker, which is one atomic
step in the file system; readers see published batches only.  So a job that
fails in between leaves nothing visible, and running it again with the same
batch id starts over.  A batch id that is published already is not written
again, which makes appends idempotent.

``replace`` hides all batches published before it; ``remove_unused`` deletes
what no reader of the current state needs.  One replacing writer at a time;
appends may run side by side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_path

APPEND, REPLACE = "append", "replace"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, found = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(found)) if fs.exists(found) else []


def _published(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(mode, batch) of every marker, in order."""
    return [tuple(n.split("-", 2)[1:]) for n in _names(spark, f"{path}/log")]


def _publish(spark: SparkSession, path: str, mode: str, batch: str) -> None:
    last = _names(spark, f"{path}/log")
    number = int(last[-1].split("-", 1)[0]) + 1 if last else 0
    fs, marker = hadoop_path(spark, f"{path}/log/{number:012d}-{mode}-{batch}")
    fs.create(marker, False).close()


def live_batches(spark: SparkSession, path: str) -> list[str]:
    out: list[str] = []
    for mode, batch in _published(spark, path):
        out = [batch] if mode == REPLACE else [*out, batch]
    return out


def write_batch(df: DataFrame, path: str, batch: str, mode: str = APPEND) -> bool:
    """Write ``df`` as a batch of the table at ``path``; False if the batch has
    been published before (nothing is written then)."""
    if mode not in (APPEND, REPLACE):
        raise ValueError("mode must be 'append' or 'replace'")
    if not re.fullmatch(r"[A-Za-z0-9_.=-]+", batch):
        raise ValueError("a batch id has letters, digits and _ . = - only")
    spark, path = df.sparkSession, path.rstrip("/")
    if any(b == batch for _, b in _published(spark, path)):
        return False
    df.write.mode("overwrite").parquet(f"{path}/data/{batch}")
    _publish(spark, path, mode, batch)
    return True


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The table's current rows."""
    path = path.rstrip("/")
    live = live_batches(spark, path)
    if not live:
        raise FileNotFoundError(f"no published batch in {path}")
    return spark.read.parquet(*[f"{path}/data/{b}" for b in live])


def remove_unused(spark: SparkSession, path: str, writing: tuple[str, ...] = ()) -> list[str]:
    """Delete the files of superseded batches and of writes that were never
    published, except those ``writing`` now; returns their ids.  The markers
    stay, so that old batch ids are still known."""
    path = path.rstrip("/")
    live = {*live_batches(spark, path), *writing}
    gone = [b for b in _names(spark, f"{path}/data") if b not in live]
    for b in gone:
        fs, found = hadoop_path(spark, f"{path}/data/{b}")
        fs.delete(found, True)
    return gone
