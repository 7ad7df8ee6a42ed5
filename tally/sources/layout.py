"""Bucketed tables for families of queries that join on one key.

Tables written with the same number of buckets on the join key meet without an
exchange, and their sorted buckets without a sort where each bucket is one file.
Worth it where many questions join the same large tables on the same key; a hot
key stays in one bucket, so such keys need ``operators.skew.hot_join`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` written as the external table ``table`` at ``path`` (replacing it),
    in ``buckets`` sorted buckets of ``keys``, one file each, and read back."""
    keys = list(keys)
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)
