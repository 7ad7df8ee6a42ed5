"""Distinct counts that can be merged (A6, A8): exact bitmaps over dense ids.

``stored_ids`` keeps one bitmap of 32,768 ids (4 KB) per group and range of ids.
Bitmaps of any groups (months, regions) are merged by OR, so a stored table of
small groups answers COUNT(DISTINCT id) for any union of them without the rows.
Both steps combine map-side.  Ids should be dense, such as keys of a dimension or
``ids.with_dense_id``; sparse ids take a bitmap each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stored_ids(df: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    """by, id_range, bits: the ids of each group; NULL ids do not count."""
    ids = df.where(F.col(id_col).isNotNull()).select(*by, F.col(id_col).cast("long").alias("_id"))
    return ids.groupBy(*by, F.bitmap_bucket_number("_id").alias("id_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def count_stored(stored: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """COUNT(DISTINCT id) per ``by`` from the bitmaps of finer groups."""
    merged = stored.groupBy(*by, "id_range").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(out))
