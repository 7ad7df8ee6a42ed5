"""Operator 13: product codes of vectors by limb-split exact matrix products.

Every vector is turned into whole numbers, cut into four equal parts, and every
part is replaced by the index of the nearest entry of that position's codebook.
Codebooks come from Lloyd rounds that start at given vectors.

Method.  The squared distance of a part x to an entry c is |x|^2 - 2 x.c + |c|^2.
All products x.c of a block of vectors come from float64 matrix products (BLAS)
that are exact: the whole numbers are broken into limbs of b bits, where
2 b + log2(length) <= 53, so that every product of limbs and every partial sum
stays below 2^53.  The products of limbs are shifted and added in int64.  That
sum wraps around at 2^64, which cancels out, as the distance itself fits in 63
bits (checked before).  ``argmin`` then takes the first of equal distances.

Spark holds the vectors and moves none of them: a round is one pass in which
each task adds up its parts per entry, one row per entry and task goes to an
aggregate, and only the entries (4 x 256 rows, whatever the input) reach the
driver.  All sums are whole numbers, so results do not depend on the order.

Results.  Rows whose vector is null, or holds null or non-finite components,
take no part.  The codes need one length divisible by four: the commonest such
length (the larger, if two are as common) counts, and vectors of other lengths,
empty ones among them, take no part either.  Repeated rows and null ids are
rows like others; the first codebook takes null ids last, and equal ids by
vector.  Fewer than 256 rows give as many entries.  Parts so far apart that a
squared distance would not fit in a long raise an OverflowError.  An empty
table gives no rows.  Columns other than vec_id, label and embedding are not
read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship_package, small_side

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 4096           # vectors whose distances are held at a time
MANTISSA = 53          # bits of a float64 in which whole numbers are exact


def limb_bits(length: int) -> int:
    """Bits of a limb for which ``length`` products add up below 2^53."""
    return (MANTISSA - max(length - 1, 0).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays l0, l1, ... with values = sum of l_i * 2^(bits * i); all
    but the last are in [0, 2^bits), the last carries the sign."""
    out, rest, mask = [], values, (1 << bits) - 1
    while rest.size and (int(rest.max()) >= 1 << bits or int(rest.min()) < -(1 << bits)):
        out.append((rest & mask).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 arrays (n x d, m x d), exact modulo 2^64."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            if bits * (i + j) < 64:
                total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of ``book``, the first of equals."""
    d = np.einsum("ij,ij->i", book, book)[None, :] - 2 * exact_products(x, book)
    index = d.argmin(axis=1)
    return index, d[np.arange(len(x)), index] + np.einsum("ij,ij->i", x, x)


def check_reach(largest: int, length: int) -> None:
    """Squared distances of parts of ``length`` components up to ``largest`` fit in a long."""
    if length * (2 * largest) ** 2 >= 1 << 63:
        raise OverflowError(f"components up to {largest} in parts of {length}: squared distances exceed a long")


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, n x d matrix) for every BLOCK rows of a list column."""
    lists = batch.column(column)
    for at in range(0, batch.num_rows, BLOCK):
        part = lists.slice(at, BLOCK)
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _add_up(books) -> Callable:
    """Rows (part, entry, n, sums): what a task's vectors add to each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        parts, m, d = book.shape
        sums, counts = np.zeros((parts, m, d), np.int64), np.zeros((parts, m), np.int64)
        for batch in batches:
            for _, rows in _blocks(batch, 0):
                for p in range(parts):
                    x = rows[:, p * d:(p + 1) * d]
                    index, _ = nearest(x, book[p])
                    order = np.argsort(index, kind="stable")
                    used, starts = np.unique(index[order], return_index=True)
                    sums[p, used] += np.add.reduceat(x[order], starts, axis=0)
                    counts[p] += np.bincount(index, minlength=m)
        part, entry = np.nonzero(counts)
        flat = sums[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * d, pa.int32()),
                                      pa.array(flat.reshape(-1), pa.int64()))],
            names=["part", "entry", "n", "sums"])
    return run


def _encode(books) -> Callable:
    """vec_id, label, code, error of every vector (columns: vector, vec_id, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        parts, _, d = book.shape
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for at, rows in _blocks(batch, 0):
                for p in range(parts):
                    index, far = nearest(rows[:, p * d:(p + 1) * d], book[p])
                    codes[at:at + len(rows), p] = index
                    error[at:at + len(rows)] += far
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """_w (whole numbers), vec_id, label of the rows whose vector is whole."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    doubles = embeddings.select(F.col("embedding").cast("array<double>").alias("_e"), "vec_id", "label")
    return doubles.where(F.col("_e").isNotNull() & F.forall("_e", fine)).select(
        F.transform("_e", lambda x: F.floor(x * scale).cast("long")).alias("_w"), "vec_id", "label")


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The codebooks (parts x entries x length) of the smallest ids: ``entries`` rows, whatever the input."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "_w").limit(entries).collect()
    whole = np.array([r["_w"] for r in rows], np.int64)
    return np.ascontiguousarray(whole.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def train(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` Lloyd rounds over all ``vectors``."""
    sc, d = vectors.sparkSession.sparkContext, books.shape[2]
    for _ in range(rounds):
        shared = sc.broadcast(books)
        added = vectors.select("_w").mapInArrow(_add_up(shared), "part int, entry int, n long, sums array<long>")
        total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
        books = books.copy()
        for r in added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(d)]
        shared.unpersist()
    return books


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and position, comma-joined."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every vector that takes part; the codebooks)."""
    if entries > 256:
        raise ValueError("an index is one byte: at most 256 entries")
    spark = embeddings.sparkSession
    ship_package(spark)
    whole = materialise(whole_vectors(embeddings, scale), "whole-vectors")
    size = F.size("_w")
    lengths = whole.where((size > 0) & (size % parts == 0)).groupBy(size.alias("n")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.array_max("_w")).alias("most"), F.min(F.array_min("_w")).alias("least"))
    common = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if common is None:
        none = whole.where("false").select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    check_reach(max(abs(common["most"]), abs(common["least"])), common["n"] // parts)
    kept = whole.where(size == common["n"])
    books = train(kept, first_books(kept, parts, entries), rounds)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    coded = kept.mapInArrow(_encode(spark.sparkContext.broadcast(books)),
                            f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded, books


def with_group_error(coded: DataFrame, by: str = "label", out: str = "label_error") -> DataFrame:
    """``coded`` (written once) with the error summed over equal ``by``, nulls together."""
    coded = materialise(coded, "codes")
    sums = small_side(materialise(
        coded.groupBy(F.col(by).alias("_by")).agg(F.sum("error").alias(out)), "label-errors"))
    return coded.join(sums, coded[by].eqNullSafe(sums["_by"])).drop("_by")


def books_digest(books: np.ndarray) -> Column:
    return F.lit(hashlib.sha256(books_text(books).encode()).hexdigest())


def code_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    coded, books = compress(embeddings)
    return with_group_error(coded).select(
        "vec_id", "code", "error", "label_error", books_digest(books).alias("codebooks_sha256"))
