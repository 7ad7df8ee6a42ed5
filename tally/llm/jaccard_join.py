"""Near duplicates: n-gram Jaccard join by MinHash banding (operator 9).

Documents are sets of five-word shingles (words: runs without white space);
two texts are linked when the Jaccard coefficient of their sets is 0.8 or
more.  A text of one to four words is a single shingle.

Banding of one fixed depth, not a forest: no trie is sorted, and no prefix is
matched or shortened per text or bucket.  Each of ``TREES`` trees holds every
text under a label of d MinHash slices, and texts meet under equal labels.
d is the largest depth, at most ``MAX_DEPTH``, at which the expected recall of
a pair exactly at the threshold, 1 - (1 - t^d)^TREES, reaches ``RECALL``; it
follows from these constants alone (4 for the values below).  A forest
shortens prefixes to find the nearest few texts whatever their distance; here
the threshold is fixed, so a deeper prefix would lose pairs at the threshold
and a shorter one would only add candidates.

1. *Sketch*, where documents are read: text key (128-bit digest of the word
   list), label per tree.  No shingle leaves the task.
2. *Text classes*: copies collapse to one class with a weight.
3. *Buckets*: classes under one label.  Buckets with the same members in
   several trees are kept once (by member count and two xor digests).
4. *Units*: buckets that share classes form a candidate component.  Near copies
   meet in most trees, so a component whose pairs are no more than those of its
   buckets together is compared as one unit, each of its pairs once; the
   buckets of others (long chains) are units of their own.  Either way every
   pair that shares a label is compared.
5. *Blocks*: a unit of many classes is dealt into parts of about ``BLOCK``
   classes (or ``BLOCK_WORDS`` words) and every pair of parts is one block, so
   no task gathers an unbounded unit and no pair is written.  A text is sent
   to as many blocks as its unit has parts.  Only texts that share a bucket
   are read again for their shingles.
6. *Exact verification* per block: intersection counts of whole sets.  A pair
   of buckets is counted in the first tree that holds it together.  A block
   returns per class its weighted link count and a spanning star.
7. *Classes of documents*: connected components of the links, by alternating
   large-star and small-star steps over written tables.

Result: one row per row of the input: doc_id, class_id (smallest doc_id of
the component), n_links (rows linked to this one, copies included).

Defined results: texts without words (null, empty) are linked to nothing
and form their own classes; copies are linked to each other; rows with a
null doc_id take part, and a class of only such rows has a null class_id; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, materialise, null_safe, row_mark, ship_package, small_side, text_of

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
TREES = 20
MAX_DEPTH = 6
RECALL = 0.9999
BLOCK = 1024
BLOCK_WORDS = 2_000_000
WHOLE = -1                   # in place of a tree: the unit is a whole component
SLICE_BITS = 10
CHUNK_WORDS = 1 << 17        # words hashed at once: temporaries stay in the cache

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def depth_for(threshold: float, trees: int, max_depth: int, recall: float) -> int:
    """The longest prefix whose expected recall at the threshold suffices."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_digests(text: str) -> np.ndarray:
    words = text.encode().split()  # bytes split at exactly \x20 \x09-\x0D
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_digests(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """One digest per shingle position (repeats included)."""
    if not len(words):
        return words
    width = min(n, len(words))
    count = len(words) - width + 1
    h = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        h = h * _MUL + words[k:k + count]
    return _mixed(h)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    a = rng.integers(1, 2 ** 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2 ** 63, size=count, dtype=np.uint64)


def _labels(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """Prefix labels (len(sets) x trees) of non-empty shingle lists."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    a, b = _permutations(trees * depth)
    out = np.zeros((len(sets), trees), dtype=np.uint64)
    for j in range(trees * depth):
        low = np.minimum.reduceat(flat * a[j] + b[j], starts)
        tree, level = divmod(j, depth)
        out[:, tree] |= (_mixed(low) >> np.uint64(64 - SLICE_BITS)) << np.uint64(64 - SLICE_BITS * (level + 1))
    return out


def _sketch(trees: int, depth: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            keys, words_in = [], []
            labels = np.zeros((batch.num_rows, trees), dtype=np.uint64)
            rows, sets, held = [], [], 0

            def flush():
                nonlocal held
                if rows:
                    labels[rows] = _labels(sets, trees, depth)
                rows.clear()
                sets.clear()
                held = 0

            for i in range(batch.num_rows):
                words = word_digests(texts[i].as_py())
                words_in.append(len(words))
                if not len(words):
                    keys.append(None)
                    continue
                keys.append(hashlib.md5(words.tobytes()).hexdigest())
                rows.append(i)
                sets.append(shingle_digests(words, shingle))
                held += len(words)
                if held >= CHUNK_WORDS:
                    flush()
            flush()
            flat = pa.array(labels.view(np.int64).reshape(-1))
            offsets = pa.array(np.arange(0, batch.num_rows * trees + 1, trees, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.string()),
                 pa.array(words_in, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                names=["doc_id", "_mark", "_key", "_words", "_labels"])
    return run


def sketch(docs: DataFrame, trees: int = TREES, depth: int = 4, shingle: int = SHINGLE) -> DataFrame:
    src = docs.select("doc_id", row_mark().alias("_mark"), text_of().alias("_text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(
        _sketch(trees, depth, shingle),
        f"doc_id {kind}, _mark bigint, _key string, _words bigint, _labels array<bigint>")


def _with_shingles(shingle: int):
    """(key, weight, labels, blocks, text) -> one row per block with the text's shingle set."""
    names = ["_block", "_tree", "_lo", "_hi", "_part", "_key", "_weight", "_labels", "_set"]
    limit = 8 << 20
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
             pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            for i in range(batch.num_rows):
                key, weight, labels, blocks, text = (batch.column(c)[i].as_py() for c in range(5))
                words = word_digests(text)
                if hashlib.md5(words.tobytes()).hexdigest() != key:
                    continue
                held = np.unique(shingle_digests(words, shingle)).tobytes()
                marks = np.array(labels, dtype=np.int64).tobytes()
                for b in blocks:
                    row = (b["_block"], b["_tree"], b["_lo"], b["_hi"], b["_part"], key, weight,
                           b"" if b["_tree"] == WHOLE else marks, held)
                    for column, value in zip(out, row):
                        column.append(value)
                    size += len(held) + len(marks) + 100
                    if size >= limit:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                        out, size = [[] for _ in names], 0
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None = None, columns: int = 8192) -> np.ndarray:
    """Intersection sizes of sorted distinct arrays: of ``left`` with ``right``, or of ``left`` with itself."""
    sets, n = left + (right or []), len(left)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    group = np.cumsum(np.concatenate([[False], flat[1:] != flat[:-1]]))
    if right is None:
        shared = (np.bincount(group) > 1)[group]
    else:
        in_right = np.bincount(group, weights=owner >= n)
        shared = ((in_right > 0) & (in_right < np.bincount(group)))[group]
    group, owner = group[shared], owner[shared]
    out = np.zeros((n, n if right is None else len(right)), dtype=np.float64)
    if not len(group):
        return out
    column = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)]))
    cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + columns, columns))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        block = np.zeros((len(sets), column[b - 1] - column[a] + 1), dtype=np.float32)
        block[owner[a:b], column[a:b] - column[a]] = 1
        out += block[:n] @ (block if right is None else block[n:]).T
    return out


def block_links(tree: int, parts: np.ndarray, lo: int, hi: int, labels: np.ndarray,
                sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Which pairs of the block are linked and first meet in this tree."""
    num, den = threshold.numerator, threshold.denominator

    def close(inter: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return den * inter >= num * (sizes[rows][:, None] + sizes[columns][None, :] - inter)

    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if lo == hi:
        every = np.arange(len(sets))
        linked = close(intersections(sets), every, every)
        np.fill_diagonal(linked, False)
    else:
        linked = np.zeros((len(sets), len(sets)), dtype=bool)
        a, b = np.flatnonzero(parts == lo), np.flatnonzero(parts == hi)
        if len(a) and len(b):
            linked[np.ix_(a, b)] = close(intersections([sets[i] for i in a], [sets[i] for i in b]), a, b)
            linked |= linked.T
    for t in range(tree):
        linked &= labels[:, t][:, None] != labels[:, t][None, :]
    return linked


def _stars(linked: np.ndarray, keys: list[str]) -> list[str]:
    """Smallest key of each member's component inside the block."""
    fresh, root = np.ones(len(keys), dtype=bool), [""] * len(keys)
    for start in sorted(range(len(keys)), key=keys.__getitem__):
        stack = [start] if fresh[start] else []
        fresh[start] = False
        while stack:
            at = stack.pop()
            root[at] = keys[start]
            met = np.flatnonzero(linked[at] & fresh)
            fresh[met] = False
            stack += met.tolist()
    return root


def _verify(threshold: Fraction):
    def one(rows: dict) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        members = list(rows.values())
        keys, weights = list(rows), np.array([r[5] for r in members], dtype=np.int64)
        labels = np.stack([np.frombuffer(r[6], dtype=np.int64) for r in members])
        sets = [np.frombuffer(r[7], dtype=np.uint64) for r in members]
        tree, lo, hi = members[0][1:4]
        linked = block_links(tree, np.array([r[4] for r in members]), lo, hi, labels, sets, threshold)
        hit = np.flatnonzero(linked.any(axis=1))
        if not len(hit):
            return None
        roots, links = _stars(linked, keys), linked @ weights
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in hit], pa.string()), pa.array([roots[i] for i in hit], pa.string()),
             pa.array(links[hit], pa.int64())], names=["_key", "_root", "_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(batch.column(c)[i].as_py() for c in (0, 1, 2, 3, 4, 6, 7, 8))
                if row[:4] != at:
                    if (out := one(rows)) is not None:
                        yield out
                    at, rows = row[:4], {}
                rows[batch.column(5)[i].as_py()] = row  # a repeated row of the corpus counts once
        if (out := one(rows)) is not None:
            yield out
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node
    of its connected component.  Alternating large-star / small-star steps;
    each round is written to the shared folder."""
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written first, so that the joins have exchanges on both sides and a hub's edges can be split
        low = materialise(both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select(
            "n", F.least("n", "m").alias("m")), "low")
        large = materialise(both.join(low, F.col("a") == F.col("n")).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = materialise(large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "least")
        small = large.join(least, F.col("a") == F.col("n")).where("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(small.unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = found


def _parts(rows: str, words: str, block: int, block_words: int) -> Column:
    return F.greatest(F.ceil(F.col(rows) / block), F.ceil(F.col(words) / block_words)).cast("long")


def text_blocks(texts: DataFrame, block: int = BLOCK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_key, _blocks) of the texts that share a bucket: the blocks each is compared in.
    ``texts`` has _key, _words and _labels."""
    entries = texts.select("_key", "_words", F.posexplode("_labels").alias("_tree", "_label"))
    buckets = entries.groupBy("_tree", "_label").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_words").alias("_w"),
        F.bit_xor(F.xxhash64("_key")).alias("_x"),
        F.bit_xor(F.xxhash64("_key", F.lit(1))).alias("_y")).where("_n > 1")
    kept = materialise(buckets.groupBy("_n", "_x", "_y").agg(
        F.min(F.struct("_tree", "_label")).alias("_at"), F.max("_w").alias("_w")).select(
        "_at._tree", "_at._label", "_n", _parts("_n", "_w", block, block_words).alias("_parts")), "buckets")
    inside = materialise(entries.join(small_side(kept), ["_tree", "_label"]), "entries")

    heads = materialise(inside.groupBy("_tree", "_label").agg(
        F.min("_key").alias("_head"), F.max("_n").cast("double").alias("_n")), "heads")
    roots = components(inside.join(heads.drop("_n"), ["_tree", "_label"]).select(
        F.col("_key").alias("a"), F.col("_head").alias("b")))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    costs = heads.join(members, F.col("_head") == F.col("node")).groupBy("root").agg(
        F.sum(F.col("_n") * F.col("_n")).alias("_cost"))
    sizes = members.join(texts.select("_key", "_words"), F.col("node") == F.col("_key")).groupBy("root").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.sum("_words").alias("_w"))
    units = materialise(sizes.join(costs, "root").select(
        "root", F.when(F.col("_n") * F.col("_n") <= F.col("_cost"), _parts("_n", "_w", block, block_words))
        .alias("_whole")), "units")
    homes = materialise(members.join(units, "root").select(
        F.col("node").alias("_key"), F.xxhash64("root").alias("_home"), "_whole"), "homes")

    own = homes.where("_whole is not null").select(
        "_key", F.lit(WHOLE).alias("_tree"), F.col("_home").alias("_label"), F.col("_whole").alias("_parts"))
    rest = inside.join(small_side(homes.where("_whole is null").select("_key")), "_key").select(
        "_key", "_tree", "_label", "_parts")
    dealt = own.unionByName(rest).withColumn("_part", F.pmod(F.xxhash64("_key", "_tree"), F.col("_parts")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1),
        lambda p: F.struct(
            F.col("_label").alias("_block"), F.col("_tree"),
            F.least("_part", p).alias("_lo"), F.greatest("_part", p).alias("_hi"), F.col("_part")))
    return dealt.groupBy("_key").agg(F.flatten(F.collect_list(pairs)).alias("_blocks"))


def near_duplicates(docs: DataFrame, threshold: Fraction = THRESHOLD, trees: int = TREES,
                    max_depth: int = MAX_DEPTH, recall: float = RECALL, block: int = BLOCK,
                    block_words: int = BLOCK_WORDS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, class_id, n_links, kept (one row of each class), row_mark for
    every row of ``docs``."""
    ship_package(docs.sparkSession)
    depth = depth_for(float(threshold), trees, max_depth, recall)
    sketches = materialise(sketch(docs, trees, depth, shingle), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"),
                     F.col("_mark").alias("c"))
    texts = materialise(sketches.where("_key is not null").groupBy("_key").agg(
        F.count(F.lit(1)).alias("_weight"), F.min(first).alias("_first"),
        F.max("_words").alias("_words"), F.min("_labels").alias("_labels")), "texts")
    wanted = materialise(text_blocks(texts, block, block_words).join(texts, "_key").select(
        "_key", "_weight", "_labels", "_blocks", F.col("_first.b").alias("_id"),
        F.col("_first.c").alias("_m")), "wanted")

    src = docs.select("doc_id", row_mark().alias("_mark"), text_of().alias("_text"))
    side = small_side(wanted)
    held = src.join(side, null_safe(src, side, [("doc_id", "_id"), ("_mark", "_m")])).select(
        "_key", "_weight", "_labels", "_blocks", "_text")
    rows = held.mapInArrow(
        _with_shingles(shingle), "_block bigint, _tree int, _lo bigint, _hi bigint, _part bigint, _key string, "
                        "_weight bigint, _labels binary, _set binary")
    at = ["_tree", "_block", "_lo", "_hi"]
    found = materialise(rows.repartition(*at).sortWithinPartitions(*at).mapInArrow(
        _verify(threshold), "_key string, _root string, _links bigint"), "links")

    roots = components(found.select(F.col("_key").alias("a"), F.col("_root").alias("b")))
    links = found.groupBy(F.col("_key").alias("_k")).agg(F.sum("_links").alias("_links"))
    member = texts.select("_key", "_weight", "_first").join(
        roots, F.col("_key") == F.col("node"), "left").join(
        links, F.col("_key") == F.col("_k"), "left").select(
        "_key", "_weight", "_first", F.coalesce("root", "_key").alias("_root"),
        F.coalesce("_links", F.lit(0)).alias("_links"))
    heads = member.groupBy("_root").agg(F.min("_first").alias("_head"))
    known = member.join(heads, "_root").select(
        F.col("_key").alias("_k"), "_head", (F.col("_links") + F.col("_weight") - 1).alias("_n"))
    joined = sketches.join(known, F.col("_key") == F.col("_k"), "left")
    alone = F.col("_key").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("_head.b")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("_n")).cast("long").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("_head.b")) & (F.col("_mark") == F.col("_head.c"))))
        .alias("kept"), F.col("_mark").alias("row_mark"))


def keep_one(docs: DataFrame, threshold: Fraction = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (all columns) with one row of each class of near duplicates.
    Rows that repeat the row that stays are collapsed to one."""
    return keep_rows(docs, near_duplicates(docs, threshold, shingle=shingle).select("doc_id", "row_mark", "kept"), "near")
