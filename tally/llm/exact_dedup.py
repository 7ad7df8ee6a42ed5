"""Exact duplicates by content-defined chunk recipes (operator 8).

Every normalised text (white space deleted, null counted as empty) is cut
into chunks where its content says so: after at least ``MIN_CHUNK``
characters a chunk ends behind the first boundary pair, and at
``MAX_CHUNK`` characters at the latest.  Boundary characters lie below U+0250, so
texts in other scripts are mostly cut every ``MAX_CHUNK`` characters.  Cutting depends on the text alone,
so equal texts have equal chunk lists and the other way round.

1. Each document is reduced, where it is read, to its *recipe*: the ordered
   list of 64-bit chunk digests.  Only recipes (about 1 % of the text) move.
2. Recipes that occur once are unique texts: equal texts have equal recipes.
3. For the rest the digests are turned into *verified identifiers*: the
   distinct (digest, chunk) pairs are counted per digest.  A digest with one
   chunk text is that chunk's identifier; one with several gets an ordinal
   per chunk text, and the documents holding it carry those ordinals too.
4. Documents with the same ordered identifier list are one group.

A group's row count, and the row that stays (most code points, then
smallest doc_id, null last), are aggregates combined before the shuffle, so
a group holding a third of all rows is never gathered in one task.

Defined results: a null text is an empty text (empty texts are one group);
rows that repeat another row (same doc_id, same text) are members of its
group and at most one of them stays; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, keep_rows, materialise, null_safe, row_mark, small_side, text_of

MIN_CHUNK = 256
MAX_CHUNK = 4096

# A chunk ends behind two characters whose code points are 5 and 4 modulo 16
# (checked up to U+024F; other scripts end at MAX_CHUNK).
_BOUND = "".join(
    "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x21, 0x250) if c % 16 == r) + "]"
    for r in (5, 4))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE_CLASS}]+", "")


def chunks(norm: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """Ordered chunks of a normalised text; their concatenation is the text."""
    pattern = f"(?s).{{{low},{high}}}?(?:(?<={_BOUND})|\\z)|.{{1,{high}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def _digest(chunk: Column, bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def recipes(docs: DataFrame, low: int = MIN_CHUNK, high: int = MAX_CHUNK,
            digest_bits: int = 64) -> DataFrame:
    """One row per distinct row of ``docs``: doc_id, row mark, length, text
    digest, recipe and how often the row repeats (``copies``)."""
    norm = docs.select("doc_id", text_of().alias("_text"), row_mark().alias("_mark")).select(
        "doc_id", "_mark", F.length("_text").cast("long").alias("_chars"),
        normalised(F.col("_text")).alias("_norm"))
    cut = norm.select(
        "doc_id", "_mark", "_chars", F.sha2("_norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("_norm"), low, high),
                    lambda c: _digest(c, digest_bits)).alias("_recipe"))
    return cut.groupBy("doc_id", "_mark", "_chars", "text_sha256", "_recipe").agg(
        F.count(F.lit(1)).alias("_copies"))


def _clashes(docs: DataFrame, repeated: DataFrame, low: int, high: int,
             digest_bits: int) -> DataFrame | None:
    """Per document holding a digest that stands for several chunk texts: the
    ordinals of its chunks under those digests, in order.  None if no digest
    of a repeated recipe is ambiguous."""
    wanted = small_side(repeated.select(F.col("doc_id").alias("_id"),
                                        F.col("_mark").alias("_m")).distinct())
    src = docs.select("doc_id", text_of().alias("_text"), row_mark().alias("_mark"))
    held = src.join(wanted, null_safe(src, wanted, [("doc_id", "_id"), ("_mark", "_m")]),
                    "left_semi")
    parts = held.select(
        "doc_id", "_mark", F.posexplode(chunks(normalised(F.col("_text")), low, high)).alias(
            "_pos", "_chunk")).withColumn("_digest", _digest(F.col("_chunk"), digest_bits))
    distinct = parts.groupBy("_digest", "_chunk").agg(F.lit(1).alias("_one"))
    several = distinct.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts")).where(
        "_texts > 1").select("_digest")
    several = materialise(several, "clashing-digests")
    if several.isEmpty():
        return None
    named = distinct.join(several, "_digest", "left_semi").groupBy("_digest").agg(
        F.sort_array(F.collect_list("_chunk")).alias("_texts"))
    return (parts.join(named, "_digest")
            .select("doc_id", "_mark", "_pos",
                    F.array_position("_texts", F.col("_chunk")).alias("_ordinal"))
            .distinct()
            .groupBy(F.col("doc_id").alias("_id"), F.col("_mark").alias("_m"))
            .agg(F.sort_array(F.collect_list(F.struct("_pos", "_ordinal"))).alias("_ordinals")))


def exact_duplicates(docs: DataFrame, low: int = MIN_CHUNK, high: int = MAX_CHUNK,
                     digest_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, and ``row_mark`` (digest of the text as given)."""
    book = materialise(recipes(docs, low, high, digest_bits), "recipes")
    often = materialise(
        book.groupBy("_recipe").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_recipe"),
        "frequent-recipes")
    repeated = materialise(book.join(often, "_recipe", "left_semi").select("doc_id", "_mark"),
                           "repeated-recipes")
    ordinals = _clashes(docs, repeated, low, high, digest_bits)
    if ordinals is None:
        listed = book.withColumn("_ordinals", F.lit(None).cast("array<struct<_pos:int,_ordinal:bigint>>"))
    else:
        listed = book.join(
            ordinals, null_safe(book, ordinals, [("doc_id", "_id"), ("_mark", "_m")]),
            "left").drop("_id", "_m")
    listed = listed.withColumn("_list", F.struct(
        "_recipe", F.coalesce("_ordinals", F.array().cast("array<struct<_pos:int,_ordinal:bigint>>"))))
    order = F.struct((-F.col("_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                     F.col("doc_id").alias("c"), F.col("_mark").alias("d"))
    # only groups of several rows are written and joined back; others stand alone
    groups = materialise(listed.groupBy("_list").agg(
        F.sum("_copies").alias("_size"), F.count(F.lit(1)).alias("_rows"),
        F.min(order).alias("_first")).where("_rows > 1").drop("_rows"), "groups")
    joined = listed.join(groups, "_list", "left")
    alone = F.col("_first").isNull()
    stays = alone | (F.col("doc_id").eqNullSafe(F.col("_first.c")) & (F.col("_mark") == F.col("_first.d")))
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("_first.c")).alias("keep_id"),
        F.coalesce("_size", "_copies").alias("group_size"), stays.alias("_stays"),
        "text_sha256", F.col("_mark").alias("row_mark"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_n")).select(
        "doc_id", "keep_id", "group_size", (F.col("_stays") & (F.col("_n") == 1)).alias("kept"),
        "text_sha256", "row_mark")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row of each group of equal texts.  Rows
    that repeat the row that stays are collapsed to one."""
    return keep_rows(docs, exact_duplicates(docs).select("doc_id", "row_mark", "kept"), "exact")
