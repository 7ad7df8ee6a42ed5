"""Operator 12: text quality by nearest-neighbour voting over latent-semantic vectors.

Method.  A document's terms are its character trigrams (hashed), the trigrams of
its characters' classes (letters, digits, marks, line ends) and how often its
word pairs and lines have come before in it.  Each of the three groups of terms
is a vector of square roots of shares, weighted by inverse document frequency
and normalised.  The document frequencies cover all documents.  A truncated
singular value decomposition of labelled documents (randomised subspace
iteration) gives the latent space.  The latent vectors of the labelled documents
are broadcast, and every document takes exact cosines with all of them in blocks
of matrix products.  Its ``NEIGHBOURS`` nearest vote: score = sum of weight *
label / sum of weights, with weight = cosine (0 if negative) ** ``SHARPNESS``.

Bounds.  The classifier is fitted on a sample of the labelled rows: ``VOTERS``
vectors vote, and ``FIT_ROWS`` of them make the latent space; both are taken by
a hash of the doc_id.  So the broadcast is at most VOTERS x RANK numbers (4 MB)
and TERMS x RANK numbers (2 MB), whatever the input, and every document costs the
same.  Everything else covers all rows.

Labels come only from rows whose crc32(doc_id as text) mod ``FOLDS`` is not
``HELD_OUT``.  Null labels, and a doc_id labelled both ways, do not count; of
several texts of one labelled doc_id the first in text order counts.  doc_id,
lang, source and labels are no inputs of a score, so equal texts score alike.

Results.  Null and empty texts have no terms and score the share of good labels
among the voters, as does any text without a neighbour; without any usable label
that share is 0.5.  A null doc_id is not held out.  Long texts are counted in
pieces of ``PIECE`` bytes, whole.  Repeated rows are scored each.  An empty table
gives no rows.  Columns other than doc_id, text and doc_id, quality are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialise, ship_package, text_of

FOLDS, HELD_OUT = 3, 1
VOTERS = 16_384
FIT_ROWS = 4_096
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK = 256            # documents whose vectors and cosines are held at a time
PIECE = 1 << 20

CONTENT = 4_096        # hashed character trigrams
CLASSES = 16
FORM = CLASSES ** 3    # trigrams of character classes
LEVELS = 8             # earlier occurrences of a word pair or line: 0, 1, 2-3, 4-7, ...
TERMS = CONTENT + FORM + 2 * LEVELS

# The characters of each class; any other ASCII character is of the
# last class, bytes of non-ASCII characters count as small letters.
CLASS_CHARACTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".", ",",
                    "!", "?", "'\"`", "()[]{}<>", "|", "#$%&*", "-_/\\", ":;")
_CLASS = np.full(256, CLASSES - 1, np.uint16)
for _i, _chars in enumerate(CLASS_CHARACTERS):
    _CLASS[[ord(c) for c in _chars]] = _i
_CLASS[128:] = 1
_WORD = regex.compile("[^" + SPACE_CLASS + "]+")


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Counts of content and form trigrams of a text's bytes, with a line end on both sides."""
    counts = np.zeros(CONTENT + FORM, np.int64)
    data = np.concatenate([[10], data, [10]]).astype(np.uint32)
    for at in range(0, len(data) - 2, PIECE):
        b = data[at:at + PIECE + 2]
        code = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(20)
        counts[:CONTENT] += np.bincount(code, minlength=CONTENT)
        c = _CLASS[b]
        counts[CONTENT:] += np.bincount(c[:-2] * CLASSES ** 2 + c[1:-1] * CLASSES + c[2:], minlength=FORM)
    return counts


def _earlier(items) -> np.ndarray:
    """How many items have come before 0, 1, 2-3, 4-7, ... times."""
    out = np.zeros(LEVELS, np.int64)
    for times, many in Counter(Counter(items).values()).items():
        out[0] += many
        for level in range(1, LEVELS):
            low = 1 << level - 1
            high = times if level == LEVELS - 1 else min(times, 2 * low)
            if times > low:
                out[level] += many * (high - low)
    return out


def term_counts(text: str, data: np.ndarray | None = None) -> np.ndarray:
    """All term counts of a text that is not empty."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) if data is None else data
    words = _WORD.findall(text)
    return np.concatenate([_trigrams(data), _earlier(zip(words, words[1:])), _earlier(text.split("\n"))])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of term counts as vectors: the three groups of terms, each of length 1."""
    x = np.sqrt(counts, dtype=np.float32)
    x[:, :len(idf)] *= idf
    for a, b in ((0, CONTENT), (CONTENT, CONTENT + FORM), (CONTENT + FORM, TERMS)):
        norm = np.sqrt(np.einsum("ij,ij->i", x[:, a:b], x[:, a:b]))[:, None]
        np.divide(x[:, a:b], norm, out=x[:, a:b], where=norm > 0)
    return x


class Space:
    """The latent space: document weights, directions (TERMS x rank) and their mean."""

    def __init__(self, idf: np.ndarray, directions: np.ndarray, mean: np.ndarray):
        self.idf, self.directions, self.mean = idf, directions, mean

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Latent vectors of length 1, and which texts have one."""
        out = np.zeros((len(texts), self.directions.shape[1]), np.float32)
        told = np.array([t != "" for t in texts], bool)
        if told.any():
            counts = np.stack([term_counts(t) for t in texts if t])
            y = weighted(counts, self.idf) @ self.directions - self.mean
            norm = np.linalg.norm(y, axis=1, keepdims=True)
            out[told] = np.divide(y, norm, out=np.zeros_like(y), where=norm > 0)
        return out, told


def latent_space(x: np.ndarray, idf: np.ndarray, rank: int = RANK, rounds: int = 6, seed: int = 11) -> Space:
    """The leading right singular directions of ``x`` by randomised subspace iteration."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    directions = np.ascontiguousarray(q @ v.T[:, :rank]).astype(np.float32)
    return Space(idf, directions, (x @ directions).mean(axis=0))


class Voters:
    def __init__(self, vectors: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS,
                 sharpness: float = SHARPNESS):
        self.vectors, self.labels = np.ascontiguousarray(vectors), labels.astype(np.float64)
        self.share = float(self.labels.mean()) if len(labels) else 0.5
        self.neighbours, self.sharpness = min(neighbours, len(labels)), sharpness

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Scores of latent vectors (at most BLOCK rows at a time)."""
        if not self.neighbours:
            return np.full(len(vectors), self.share)
        cosines = vectors @ self.vectors.T
        near = np.argpartition(-cosines, self.neighbours - 1, axis=1)[:, :self.neighbours]
        weight = np.clip(np.take_along_axis(cosines, near, axis=1).astype(np.float64), 0, 1) ** self.sharpness
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1)
        return np.divide(voted, total, out=np.full(len(vectors), self.share), where=total > 0)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    for at in range(0, batch.num_rows, BLOCK):
        yield at, [t.as_py() for t in batch.column(0).slice(at, BLOCK)]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (term, n): in how many of a task's texts each trigram occurs; term -1 counts the texts."""
    counts, texts = np.zeros(CONTENT + FORM, np.int64), 0
    for batch in batches:
        for t in batch.column(0):
            if data := t.as_buffer():
                if data.size:
                    counts += _trigrams(np.frombuffer(data, np.uint8)) > 0
                    texts += 1
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()),
                                      pa.array(np.append(counts[used], texts), pa.int64())], names=["term", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts as pairs of lists (columns: text)."""
    for batch in batches:
        for t in batch.column(0):
            counts = term_counts(t.as_py())
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([used.astype(np.int32).tobytes()]),
                                              pa.array([counts[used].tobytes()])], names=["terms", "counts"])


def _latent(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _blocks(batch):
                v, _ = shared.value.vectors(texts)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.tobytes() for row in v]), *part.columns[1:]], names=["vector", "id", "quality"])
    return run


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, voters = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, voters.share)
            if space is not None:
                for at, texts in _blocks(batch):
                    v, told = space.vectors(texts)
                    scores[at:at + len(texts)][told] = voters.vote(v[told])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores)], names=["doc_id", "score"])
    return run


def voter_rows(docs: DataFrame, labels: DataFrame, voters: int = VOTERS) -> DataFrame:
    """text, id, quality, order of at most ``voters`` labelled training documents (written)."""
    asked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).where(
        F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    asked = asked.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
    asked = asked.where("quality = _other").select("id", "quality", F.xxhash64("id").alias("order"))
    chosen = materialise(asked.orderBy("order", "id").limit(voters), "voters")
    texts = docs.select(text_of().alias("text"), F.col("doc_id").alias("_id")).where("text <> ''")
    # at most ``voters`` rows, so the broadcast is bounded
    met = texts.join(F.broadcast(chosen), texts["_id"] == chosen["id"])
    return materialise(met.groupBy("id", "quality", "order").agg(F.min("text").alias("text")), "voter-texts")


def fit(docs: DataFrame, labels: DataFrame, voters: int = VOTERS, fit_rows: int = FIT_ROWS, rank: int = RANK,
        neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> tuple[Space | None, Voters]:
    spark = docs.sparkSession
    rows = voter_rows(docs, labels, voters)
    sample = rows.orderBy("order", "id").limit(fit_rows).select("text").mapInArrow(
        _counted, "terms binary, counts binary").collect()
    if not sample:
        return None, Voters(np.zeros((0, 0), np.float32), np.zeros(0))
    idf = np.zeros(CONTENT + FORM, np.float64)
    texts = 0
    # one row per trigram bucket, whatever the input
    for r in docs.select(text_of().alias("text")).mapInArrow(_document_frequencies, "term int, n long").groupBy(
            "term").agg(F.sum("n").alias("n")).collect():
        if r["term"] < 0:
            texts = r["n"]
        else:
            idf[r["term"]] = r["n"]
    idf = (np.log((texts + 1) / (idf + 1)) + 1).astype(np.float32)
    x = np.zeros((len(sample), TERMS), np.float32)
    for i, r in enumerate(sample):
        used = np.frombuffer(r["terms"], np.int32)
        x[i, used] = np.frombuffer(r["counts"], np.int64)
    del sample
    space = latent_space(weighted(x, idf), idf, rank)
    del x
    found = rows.select("text", "id", "quality").mapInArrow(
        _latent(spark.sparkContext.broadcast(space)),
        f"vector binary, id {rows.schema['id'].dataType.simpleString()}, quality int").orderBy("id").collect()
    vectors = np.stack([np.frombuffer(r["vector"], np.float32) for r in found])
    return space, Voters(vectors, np.array([r["quality"] for r in found]), neighbours, sharpness)


def score_quality(docs: DataFrame, labels: DataFrame, voters: int = VOTERS, fit_rows: int = FIT_ROWS, rank: int = RANK,
                  neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    ship_package(docs.sparkSession)
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    shared = docs.sparkSession.sparkContext.broadcast(
        fit(docs, labels, voters, fit_rows, rank, neighbours, sharpness))
    src = docs.select(text_of().alias("text"), "doc_id")
    kind = src.schema["doc_id"].dataType.simpleString()
    scored = src.mapInArrow(_scored(shared), f"doc_id {kind}, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
