"""Mixing sources to target weights (operator 3).

Capped water-filling over one row per source: every source's target is its
weight's share of the budget, clamped at ``max_epochs`` times its size; what
the clamped sources cannot take goes to the others by weight until no
target is above its cap.  In ascending order of cap / weight the clamped
sources are a prefix, so running sums over that order give the fixed point
without iterating.  The comparison is done on whole numbers
(decimal(38,0)); a target needs one division and one multiplication.

Sampling: a source whose target is ``e`` times its size takes each document
``floor(e)`` times, and once more the documents that come first in a seeded
order (the md5 of seed, doc_id and text) as long as they fit into the rest
of the target.  The cut can fall before a long document, so ``REFILLS`` more
rounds go on behind it with the documents that are no longer than what is still
missing, in the same order and by the same cut.  Of the documents behind the
last cut, the one whose size is nearest to what is missing then is taken too, if
that brings the source nearer to its target.  Where an order is cut is found in
two steps, sums over 4096 prefix buckets of the digest and then the documents of
the one bucket that holds the cut, so no window runs over all documents of a
source.  Every later decision needs only the document's own digest and size and
its source's row.

Defined results: a null text has size 0; documents without words take no
words; null is a source of its own, last in order; a source without words
has target 0; rows with the same doc_id and text are taken or left
together; an empty table gives no rows.  The table of sources (one row per
source) is the only thing ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, free_names, materialise, small_side, text_of

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)          # budget as a fraction of all sizes: 150 %
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKET_DIGITS = 3       # 16**3 prefix buckets
REFILLS = 3
ANY_SIZE = (1 << 63) - 1


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def order_digest(seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("text")))


def water_fill(sources: DataFrame, weights=WEIGHTS, share=SHARE,
               max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size)."""
    whole = lambda c: c.cast("decimal(38,0)")
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    ranked = sources.withColumn("_turn", F.row_number().over(turn))
    weighted = ranked.withColumn(
        "_w", whole(F.element_at(F.array(*[F.lit(w) for w in weights]),
                                 (F.pmod(F.col("_turn") - 1, F.lit(len(weights))) + 1).cast("int")))
    ).withColumn("_cap", whole(F.col("source_size") * max_epochs))
    by_ratio = Window.orderBy((F.col("_cap").cast("double") / F.col("_w").cast("double")),
                              "_turn").rowsBetween(Window.unboundedPreceding, -1)
    num, den = share
    run = weighted.select(
        "*", F.coalesce(whole(F.sum("_cap").over(by_ratio)), whole(F.lit(0))).alias("_cap_before"),
        F.coalesce(whole(F.sum("_w").over(by_ratio)), whole(F.lit(0))).alias("_w_before"),
        whole(F.sum("_w").over(every)).alias("_w_all"),
        whole(F.sum("source_size").over(every)).alias("_all"))
    clamped = run.withColumn(
        "_full", whole(whole(den * F.col("_cap")) * whole(F.col("_w_all") - F.col("_w_before")))
        <= whole(F.col("_w") * whole(num * F.col("_all") - den * F.col("_cap_before"))))
    rest = clamped.select(
        "*", F.coalesce(whole(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(every)),
                        whole(F.lit(0))).alias("_cap_full"),
        whole(F.sum(F.when(~F.col("_full"), F.col("_w"))).over(every)).alias("_w_rest"))
    level = ((num * F.col("_all") - den * F.col("_cap_full")).cast("double")
             / (F.lit(float(den)) * F.col("_w_rest").cast("double")))
    return rest.select(
        "source", "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double"))
        .otherwise(F.col("_w").cast("double") * level).alias("target"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): one narrow row per document (doc_id, source, size,
    ``_digest``), and one row per source with its target, whole repetitions
    and which documents are taken once more: ``rounds`` (those with after < digest <=
    upto and at most ``most`` words) and ``fill`` (the one with this digest)."""
    sizes = materialise(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        word_count(text_of()).alias("size"), order_digest(seed).alias("_digest")), "mix-sizes")
    targets = materialise(water_fill(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")),
        weights, share, max_epochs), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a zero share of a source that has words still leaves its row, with nothing taken
    goal = targets.withColumn("whole", F.floor(epochs)).withColumn(
        "_rest", F.col("target") - F.col("whole") * F.col("source_size"))

    known = materialise(goal.where("_rest > 0").select(
        F.col("source").alias("_s"), F.col("_rest").alias("_missing"), F.lit("").alias("_upto"),
        F.array().cast(f"array<{_ROUND}>").alias("_rounds")), "mix-goals")
    for i in range(REFILLS + 1):
        known = _next_round(sizes, known, i)
    known_side = small_side(known)
    off = F.abs(F.col("size") - F.col("_missing"))
    fill = sizes.join(known_side, sizes["source"].eqNullSafe(known_side["_s"])).where(
        (F.col("_digest") > F.col("_upto")) & (off < F.col("_missing"))).groupBy(F.col("_s").alias("_f")).agg(
        F.min(F.struct(off.alias("a"), F.col("_digest").alias("b"))).alias("_fill"))
    out = goal.join(known.select(F.col("_s").alias("_k"), "_rounds"),
                    F.col("source").eqNullSafe(F.col("_k")), "left")
    out = out.join(fill, F.col("source").eqNullSafe(F.col("_f")), "left")
    plan = out.select("source", "source_size", "target", F.col("whole").cast("long").alias("whole"),
                      F.coalesce("_rounds", F.array().cast(f"array<{_ROUND}>")).alias("rounds"),
                      F.col("_fill.b").alias("fill"))
    return sizes, materialise(plan, "mix-plan")


_ROUND = "struct<after: string, upto: string, most: bigint>"


def _next_round(sizes: DataFrame, known: DataFrame, number: int) -> DataFrame:
    """``known`` (one row per source: _s, _missing, _upto, _rounds) after one more
    round over the documents behind ``_upto``: all of them in round 0, then those
    with at most ``_missing`` words."""
    side = small_side(known)
    most = F.lit(ANY_SIZE) if number == 0 else F.floor("_missing").cast("long")
    rows = sizes.join(side, sizes["source"].eqNullSafe(side["_s"])).where(
        (F.col("_digest") > F.col("_upto")) & (F.col("size") <= most)).select("_s", "_digest", "size", "_missing")
    prefix = F.substring("_digest", 1, BUCKET_DIGITS)
    in_order = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = rows.groupBy("_s", "_missing", prefix.alias("_bucket")).agg(
        F.sum("size").alias("_in"), F.max("_digest").alias("_last")).withColumn("_end", F.sum("_in").over(in_order))
    fits = F.col("_end") <= F.col("_missing")
    cut = materialise(buckets.groupBy("_s", "_missing").agg(
        F.max(F.when(fits, F.col("_end"))).alias("_end"), F.max(F.when(fits, F.col("_last"))).alias("_last"),
        F.min(F.when(~fits, F.col("_bucket"))).alias("_b")).select(
        F.col("_s").alias("_c"), "_missing", F.coalesce("_end", F.lit(0)).alias("_start"), "_last", "_b"), f"mix-cut-{number}")
    # the documents of the bucket that holds the cut; equal digests count as one
    cut_side = small_side(cut.drop("_missing"))
    near = rows.join(cut_side, rows["_s"].eqNullSafe(cut_side["_c"]) & (prefix == cut_side["_b"])).groupBy(
        "_s", "_missing", "_start", "_digest").agg(F.sum("size").alias("_size"))
    fine = Window.partitionBy("_s").orderBy("_digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = near.withColumn("_end", F.col("_start") + F.sum("_size").over(fine)).where("_end <= _missing").groupBy(
        F.col("_s").alias("_l")).agg(F.max("_digest").alias("_fine"), F.max("_end").alias("_end"))
    new = cut.join(last, F.col("_c").eqNullSafe(F.col("_l")), "left").select(
        "_c", F.coalesce("_fine", "_last").alias("_to"), F.coalesce("_end", "_start").alias("_got"))
    upto = F.coalesce("_to", "_upto")
    return materialise(known.join(new, F.col("_s").eqNullSafe(F.col("_c")), "left").select(
        "_s", (F.col("_missing") - F.coalesce("_got", F.lit(0))).alias("_missing"), upto.alias("_upto"),
        F.concat("_rounds", F.array(F.struct(F.col("_upto").alias("after"), upto.alias("upto"), most.alias("most"))))
        .alias("_rounds")), f"mix-known-{number}")


def _repeats(digest: str, size: Column, plan: str, max_epochs: int) -> Column:
    d = F.col(digest)
    taken = F.exists(F.col(f"{plan}rounds"), lambda r: (d > r["after"]) & (d <= r["upto"]) & (size <= r["most"]))
    more = F.when(taken | F.coalesce(d == F.col(f"{plan}fill"), F.lit(False)), 1).otherwise(0)
    return F.least(F.col(f"{plan}whole") + more, F.lit(max_epochs).cast("long"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, repeats for every document."""
    sizes, plan = mix_plan(docs, weights, share, max_epochs, seed)
    side = small_side(plan.withColumnRenamed("source", "_s"))
    repeats = _repeats("_digest", F.col("size"), "", max_epochs)
    return sizes.join(side, sizes["source"].eqNullSafe(side["_s"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats"))


def sample(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS,
           seed: str = SEED) -> DataFrame:
    """``docs`` (all columns), each row as often as the mix takes it.  The
    texts are not moved: a row needs only its own digest and size and its source's row."""
    cols = docs.columns
    _, plan = mix_plan(docs, weights, share, max_epochs, seed)
    key, digest, source, own, n, i = free_names(docs, "_t_key", "_t_digest", "_t_source", "_t_plan", "_t_n", "_t_i")
    side = small_side(plan.select(F.col("source").alias(source), F.struct("whole", "rounds", "fill").alias(own)))
    marked = docs.withColumn(key, F.col("source").cast("string")).withColumn(digest, order_digest(seed))
    joined = marked.join(side, marked[key].eqNullSafe(side[source]))
    out = joined.withColumn(n, _repeats(digest, word_count(text_of()), f"{own}.", max_epochs).cast("int")).where(F.col(n) > 0)
    return out.withColumn(i, F.explode(F.array_repeat(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in cols])
