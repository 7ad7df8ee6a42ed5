"""Operator 11: how text filters interact, from a sparse document-term matrix.

Five filters fail a document: A, too few words; B, too few different words;
C, too many capitals; D, a character of a list; E, the text of a smaller doc_id.
For every order of the filters and every step the audit counts what is kept,
removed, redundant (failing, but removed before), failed by this filter alone,
and lost of good and of toxic documents; ``shapley`` is a filter's removals
summed over all orders.

Method.  The documents are cut into shards of about ``SHARD_BYTES`` of text where they
lie; a shard is a word list and CSR arrays over it (row bounds, columns, counts).
A first pass writes the different words of each shard; those of all shards are the
global dictionary, each with a code: its 63-bit hash, or, for words that share a
hash (counted over the whole dictionary; about n^2 / 2^64 of n words), a negative
number of their own.  So a code stands for one word, and in a second pass a shard
turns its columns into codes in the Python worker that cuts it, without a join.
Row sums (words) and counts of nonzero cells (different codes) decide A and B, the
other flags are attached by document, and one aggregate counts documents by part,
set of failed filters and labels; only those counts meet the 120 orders.

What moves: the different words of each task once, a hash per different word, a
digest and the flags per document.  Shards are neither written nor handed to Spark
as rows (``shards`` does so for other uses): a task holds one in its Python worker,
or one document, and rows are words and documents' figures.

Results.  A null text is empty: no words, so A fails and B does not.  A null lang
counts as the empty string.  Repeated rows are documents like others; with equal
doc_ids neither is smaller, and a null doc_id is neither smaller nor larger than
another, so E passes it.  A doc_id with several label rows is good (toxic) if
one of them says so.  Equal texts are found by their SHA-256.  An empty table
gives no rows.  Columns other than doc_id, text, lang (documents) and doc_id,
quality, toxic (labels) are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship_package, text_of

SHARD_BYTES = 2 << 20
CODE_BITS = 63
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITALS_PCT = 3
SPECIAL = "#$%&*|"
FILTERS = "ABCDE"

_SEED = 42  # of Spark's xxhash64
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_SPECIAL = np.array([chr(b) in SPECIAL for b in range(256)])
_INNER = np.array([b & 0xC0 == 0x80 for b in range(256)])  # bytes that begin no code point

CELLS = "shard long, cols array<long>, counts array<int>, bounds array<long>"
DOCS = "parts array<string>, digests array<binary>, chars array<long>, capitals array<long>, specials array<long>"


def _hits(texts: pa.LargeStringArray, wanted: np.ndarray) -> np.ndarray:
    """Per text, how many of its bytes are in the table ``wanted``."""
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(len(texts), np.int64)
    found = np.flatnonzero(wanted[np.frombuffer(data, np.uint8)[at[0]:at[-1]]]) + at[0]
    return np.diff(np.searchsorted(found, at))


def _one(values, kind: pa.DataType | None = None) -> pa.Array:
    """A list column of one row."""
    values = pa.array(values, kind) if not isinstance(values, pa.Array) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _codes(code_bits: int, clashes: dict[str, int]):
    """Gives the codes of words.  ``clashes``: the words with codes of their own, if any."""
    own = None if not clashes else (pa.array(list(clashes), pa.string()), np.array(list(clashes.values()), np.int64))
    mask = np.uint64((1 << code_bits) - 1)

    def of(words: pa.LargeStringArray) -> np.ndarray:
        hashes = map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_numpy(zero_copy_only=False), itertools.repeat(_SEED))
        codes = (np.fromiter(hashes, np.uint64, len(words)) & mask).astype(np.int64)
        if own is not None:
            found = pc.index_in(words.cast(pa.string()), value_set=own[0]).fill_null(-1).to_numpy()
            codes = np.where(found < 0, codes, own[1][found])
        return codes
    return of


def _cells(texts: pa.LargeStringArray, codes_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row bounds, columns, counts) of the document-term matrix, columns ascending in each row."""
    pieces = pc.ascii_split_whitespace(texts)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    coded = pieces.flatten().dictionary_encode()
    words, cols = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False).astype(bool)  # the split leaves '' at a text's ends
    codes = codes_of(words)
    order = np.argsort(codes, kind="stable")
    codes, place = codes[order], np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held, width = real[cols], max(len(words), 1)
    cell, counts = np.unique(rows[held] * width + place[cols[held]], return_counts=True)
    bounds = np.searchsorted(cell, np.arange(len(texts) + 1) * width)
    return bounds, codes[cell % width], counts


def _cut(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[list[pa.Array]]:
    """The columns of one shard after the other; the first, the text, makes its size."""
    held, size = [], 0

    def shard() -> list[pa.Array]:
        table = pa.Table.from_batches(held).combine_chunks()
        text, *rest = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns)
        return [text.cast(pa.large_string()), *rest]

    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            held.append(batch.slice(at, 250))
            size += held[-1].column(0).nbytes
            if size >= shard_bytes:
                yield shard()
                held, size = [], 0
    if held:
        yield shard()


def _words(shard_bytes: int):
    """The different words of each shard (column: text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, in _cut(batches, shard_bytes):
            words = pc.ascii_split_whitespace(text).flatten().unique()
            words = words.filter(pc.not_equal(words, ""))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string())], names=["word"])
    return run


def _shards(shard_bytes: int, codes_of):
    """Shards of the documents (columns: text, doc_id, part, digest), with codes for columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for number, (text, doc_id, part, digest) in enumerate(_cut(batches, shard_bytes), first):
            bounds, cols, counts = _cells(text, codes_of)
            chars = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), _one(cols, pa.int64()), _one(counts, pa.int32()), _one(bounds, pa.int64()),
                 _one(part.cast(pa.string())), _one(digest.cast(pa.binary())), _one(chars - _hits(text, _INNER), pa.int64()),
                 _one(_hits(text, _CAPITAL), pa.int64()), _one(_hits(text, _SPECIAL), pa.int64()), _one(doc_id)],
                names=["shard", "cols", "counts", "bounds", "parts", "digests", "chars", "capitals", "specials", "doc_ids"])
    return run


def _row_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: words are row sums, different words nonzero cells."""
    for batch in batches:
        for i in range(batch.num_rows):
            own = {n: batch.column(n).slice(i, 1).flatten() for n in batch.schema.names if n != "shard"}
            bounds, cols = own["bounds"].to_numpy(), own["cols"].to_numpy()
            upto = np.concatenate([[0], np.cumsum(own["counts"].to_numpy(), dtype=np.int64)])
            fresh = np.ones(len(cols) + 1, np.int64)  # cells whose code differs from the one before in the row
            fresh[1:-1] = cols[1:] != cols[:-1]
            fresh[bounds] = 1
            nonzero = np.concatenate([[0], np.cumsum(fresh[:-1])])
            yield pa.RecordBatch.from_arrays(
                [own["doc_ids"], own["parts"], own["digests"], pa.array(upto[bounds[1:]] - upto[bounds[:-1]]),
                 pa.array(nonzero[bounds[1:]] - nonzero[bounds[:-1]]), own["chars"], own["capitals"], own["specials"]],
                names=["doc_id", "part", "digest", "n_words", "n_distinct", "n_chars", "n_capitals", "n_special"])


class TermMatrix:
    """The document-term matrix of a corpus: ``dictionary`` (word, code) and
    ``shards`` (CSR arrays over codes, with the documents of the rows)."""

    def __init__(self, docs: DataFrame, shard_bytes: int = SHARD_BYTES, code_bits: int = CODE_BITS):
        ship_package(docs.sparkSession)
        self._docs = docs.select(
            text_of().alias("text"), "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text_of(), 256)).alias("digest"))
        self._id_kind = self._docs.schema["doc_id"].dataType.simpleString()
        self._shard_bytes, self._code_bits = shard_bytes, code_bits
        self._code = lambda w: F.xxhash64(w).bitwiseAND((1 << code_bits) - 1)
        self._words = self._docs.select("text").mapInArrow(_words(shard_bytes), "word string").distinct()
        self._clashes = self._find_clashes()

    def _find_clashes(self) -> dict[str, int]:
        """Codes of the words whose hash another word has: almost always none,
        and n^2 / 2^64 of n words."""
        shared = self._words.groupBy(self._code("word").alias("code")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        codes = [r["code"] for r in shared.collect()]
        if not codes:
            return {}
        words = self._words.where(self._code("word").isin(codes)).collect()
        return {w: -1 - i for i, w in enumerate(sorted(r["word"] for r in words))}

    @property
    def dictionary(self) -> DataFrame:
        code = self._code("word")
        for w, c in self._clashes.items():
            code = F.when(F.col("word") == w, F.lit(c)).otherwise(code)
        return self._words.select("word", code.alias("code"))

    def _cut(self):
        return _shards(self._shard_bytes, _codes(self._code_bits, self._clashes))

    @property
    def shards(self) -> DataFrame:
        return self._docs.mapInArrow(self._cut(), f"{CELLS}, {DOCS}, doc_ids array<{self._id_kind}>")

    def documents(self) -> DataFrame:
        """doc_id, part, digest, n_words, n_distinct, n_chars, n_capitals, n_special per row of the matrix."""
        shards = self._cut()
        return self._docs.mapInArrow(
            lambda batches: _row_sums(shards(batches)),
            f"doc_id {self._id_kind}, part string, digest binary, n_words long, n_distinct long, "
            "n_chars long, n_capitals long, n_special long")


def filter_flags(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, part and the conditions A to E (true: the document fails) of every document."""
    rows = materialise(TermMatrix(docs, shard_bytes).documents(), "term-rows")
    first = rows.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1").drop("_n")
    return rows.join(first, rows["digest"] == first["_digest"], "left").select(
        "doc_id", "part",
        (F.col("n_words") < MIN_WORDS).alias("A"),
        (100 * F.col("n_distinct") < MIN_DISTINCT_PCT * F.col("n_words")).alias("B"),
        (100 * F.col("n_capitals") > MAX_CAPITALS_PCT * F.col("n_chars")).alias("C"),
        (F.col("n_special") > 0).alias("D"),
        F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)).alias("E"))


def with_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``flags`` with ``good`` (quality 1) and ``toxic`` (toxic 1) of the doc_id."""
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    known = labels.groupBy(F.col("doc_id").alias("_label_id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    return flags.join(known, flags["doc_id"] == known["_label_id"], "left").select(
        *flags.columns, *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")])


def interactions(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of ``flags`` (part, a boolean per letter of ``filters``, good, toxic)
    for every order of the filters and every step."""
    failed = F.concat(*[F.when(F.col(c), F.lit(c)).otherwise(F.lit("")) for c in filters])
    sets = flags.groupBy("part", failed.alias("failed"), "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    orders = ["".join(o) for o in itertools.permutations(filters)]
    steps = sets.withColumn("filter_order", F.explode(F.lit(orders))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    fails = F.expr("contains(failed, substr(filter_order, step, 1))")
    out_before = F.expr("length(translate(failed, substr(filter_order, 1, step - 1), '')) < length(failed)")
    here = fails & ~out_before
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    share = F.col("n") * F.call_function("div", F.lit(math.factorial(len(filters))), F.greatest(F.length("failed"), F.lit(1)))
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~out_before).alias("kept"), total(here).alias("removed"),
        total(fails & out_before).alias("redundant"), total(fails & (F.length("failed") == 1)).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"), total(here & F.col("toxic")).alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, filter_order, step and the counts of the five filters over ``docs``."""
    return interactions(with_labels(filter_flags(docs, shard_bytes), labels))
