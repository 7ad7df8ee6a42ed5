"""Toxicity by class-conditional Kneser-Ney models (operator 5).

Two character models, one of toxic and one of ordinary training texts, read
the words of a text (runs of word characters, lower case, with marks for
their ends).  Both are interpolated Kneser-Ney models of order ``ORDER``:

* the highest order counts the n-grams of the class;
* orders above ``SHARED`` count, per class, in how many contexts an n-gram was
  seen (continuation counts);
* orders up to ``SHARED`` are one set of continuation counts for both classes,
  so rare expressions fall back to counts that say nothing about the class.

The probability of a character under one class divided by that under the
other needs no class model below the shared orders: where an n-gram is
unknown, the ratio of the two backoff weights is carried to the next shorter
one, and at the shared orders it ends.  The tables hold that one number per
n-gram and per context.

A word's log ratio is the sum over its characters.  A text has four figures,
each normalised by length: the log ratio per character of the whole text,
that of its best window of ``WINDOW`` words, the mean of its ``TOP`` most
telling words, and the excess of telling words per word.  A logistic function
fitted on labelled rows the models have not seen makes them a probability.

Spark does the counting over all labelled training rows, without sampling:
tasks count n-grams of their texts, Spark sums them, derives the shorter
orders as aggregates and the log ratios by joins of neighbouring orders.
Every n-gram is kept whatever its count, so the model grows with the training
texts.  It is a written table, and texts meet it in one of two ways that give
the same figures:

* A model of at most ``MAPPED_ROWS`` rows (``_KEY`` and a double each: 128 MB) is
  streamed, sorted, into two files that Spark hands out; scoring tasks map them
  and look up the words of many texts at once by binary search.
* A larger one is joined.  Where documents are read, about ``SHARD_TEXT``
  characters of texts become one written row: the texts as codes of the shard's
  different words.  The different n-grams of each shard are joined with the
  model, and each shard gets the ratios of its n-grams back.  Nothing of the
  model then goes to the driver, to a broadcast or to one task.

The driver holds the fitting rows and five weights.

Labelled rows are dealt by r = crc32(doc_id as text) mod ``FOLDS``: r = 0 is
held out, r = 4 fits the logistic function (at most ``FIT_ROWS`` rows, in
order of a digest), the rest train the models.  Labels, language, source
and doc_id are not inputs of a score.

Defined results: a null text is empty; a text without words gets the share
of toxic labels among the fitting rows; several labels of a doc_id count as
toxic if one is; null labels are ignored; without labels of both classes
every score is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    free_names, materialise, null_safe, publish_all, row_mark, ship_package, small_side, text_of,
)

FOLDS = 5
ORDER = 6
SHARED = 3
DISCOUNT = 0.75
WINDOW = 50
TOP = 3
TELLING = 2.0
FIT_ROWS = 20_000
BEGIN, END = "\x02", "\x03"
_WORD = re.compile(r"\w+")
_HELD_WORDS = 100_000
_NEW_WORDS = 20_000
_HELD_TEXT = 1 << 21
MAPPED_ROWS = 1 << 22
SHARD_TEXT = 1 << 24
_KEY = np.dtype(f"<U{ORDER}")
_BACKOFF = "\x04"  # ends the key of a context; no n-gram holds it
_FIGURES = ("x0", "x1", "x2", "x3")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def marked(word: str) -> str:
    return BEGIN * (ORDER - 1) + word + END


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        grams: tuple[Counter, Counter] = (Counter(), Counter())
        for words, found in zip(held, grams):
            for word, n in words.items():
                m = marked(word)
                for k in range(len(word) + 1):
                    found[m[k:k + ORDER]] += n
            words.clear()
        keys = list(grams[0].keys() | grams[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([grams[1][k] for k in keys], pa.int64()),
             pa.array([grams[0][k] for k in keys], pa.int64())], names=["gram", "toxic", "plain"])

    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            held[label.as_py()].update(words_of(text.as_py()))
            if len(held[0]) + len(held[1]) >= _HELD_WORDS:
                yield flush()
    if held[0] or held[1]:
        yield flush()


def train(rows: DataFrame) -> DataFrame | None:
    """The table of log ratios (key, value) learnt from labelled rows (_text,
    _toxic); None if a class is missing."""
    level = materialise(
        rows.mapInArrow(_count_grams, "gram string, toxic bigint, plain bigint")
        .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
        .withColumn("any", F.lit(1).cast("long")), f"grams-{ORDER}")
    totals = level.agg(F.sum("toxic"), F.sum("plain")).first()
    if not totals[0] or not totals[1]:
        return None
    seen = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
    levels = {ORDER: level}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = materialise(levels[n + 1].groupBy(F.expr(f"substring(gram, 2, {n})").alias("gram")).agg(
            F.sum(seen("toxic")).cast("long").alias("toxic"), F.sum(seen("plain")).cast("long").alias("plain"),
            F.count(F.lit(1)).alias("any")), f"grams-{n}")
    return materialise(_log_ratios(levels), "ratios")


def _log_ratios(levels: dict[int, DataFrame]) -> DataFrame:
    """key, value: the log ratio of every n-gram above the shared orders, and
    that of the backoff weights of every context (key ends in ``_BACKOFF``).
    The end of an n-gram is an n-gram of the order below, so no join loses one."""
    left = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    total, kinds = levels[1].agg(F.sum("any"), F.count(F.lit(1))).first()
    lower = levels[1].select(F.col("gram").alias("_end"), (
        (left("any") + DISCOUNT * kinds / (kinds + 1)) / F.lit(float(total))).alias("_p"))
    out = []
    for n in range(2, ORDER + 1):
        context, end = F.expr(f"substring(gram, 1, {n - 1})"), F.expr(f"substring(gram, 2, {n - 1})")
        level = levels[n].withColumn("_context", context).withColumn("_end", end)
        if n <= SHARED:
            sums = level.groupBy("_context").agg(F.sum("any").alias("_sum"), F.count(F.lit(1)).alias("_kinds"))
            lower = materialise(level.join(sums, "_context").join(lower, "_end").select(F.col("gram").alias("_end"), (
                (left("any") + DISCOUNT * F.col("_kinds") * F.col("_p")) / F.col("_sum")).alias("_p")), f"p-{n}")
            continue
        if n == SHARED + 1:
            lower = lower.select("_end", F.col("_p").alias("_p_toxic"), F.col("_p").alias("_p_plain"))
        sums = level.groupBy("_context").agg(
            *(F.sum(c).alias(f"_n_{c}") for c in ("toxic", "plain")),
            *(F.sum(left(c)).alias(f"_k_{c}") for c in ("toxic", "plain")))
        known = lambda c: F.col(f"_n_{c}") > 0
        sums = materialise(sums.select("_context", "_n_toxic", "_n_plain", *(
            F.when(known(c), 1 - F.col(f"_k_{c}") / F.col(f"_n_{c}")).otherwise(1.0).alias(f"_w_{c}")
            for c in ("toxic", "plain"))), f"contexts-{n}")
        lower = materialise(level.join(sums, "_context").join(lower, "_end").select(
            F.col("gram").alias("_end"), *(
                (F.when(known(c), left(c) / F.col(f"_n_{c}")).otherwise(0.0)
                 + F.col(f"_w_{c}") * F.col(f"_p_{c}")).alias(f"_p_{c}") for c in ("toxic", "plain"))), f"p-{n}")
        out += [lower.select(F.col("_end").alias("key"), F.log(F.col("_p_toxic") / F.col("_p_plain")).alias("value")),
                sums.select(F.concat("_context", F.lit(_BACKOFF)).alias("key"),
                            F.log(F.col("_w_toxic") / F.col("_w_plain")).alias("value"))]
    table = out[0]
    for more in out[1:]:
        table = table.unionByName(more)
    return table


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.array(batch.column(0).to_pylist(), dtype=_KEY).tobytes()
        values = batch.column(1).to_numpy(zero_copy_only=False).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([keys], pa.binary()), pa.array([values], pa.binary())],
                                         names=["keys", "values"])


def _write_model(spark: SparkSession, table: DataFrame) -> MappedRatios:
    """Sorted keys and their values as two files, streamed by the driver one
    partition at a time.  Spark orders strings as numpy does, by code points."""
    packed = table.orderBy("key").mapInArrow(_pack, "keys binary, values binary")
    run = uuid.uuid4().hex
    names = [f"toxicity-keys-{run}.bin", f"toxicity-values-{run}.bin"]
    for path in publish_all(spark, names, packed.toLocalIterator()):
        spark.sparkContext.addFile(path)
    return MappedRatios(*names)


def _gram_ratios(grams: DataFrame, table: DataFrame) -> DataFrame:
    """(gram, ratio) of different n-grams of the highest order: that of the longest
    known end and of the backoff weights on the way to it.  Most are known as they are."""
    own = table.select(F.col("key").alias("_k"), F.col("value").alias("_v"))
    met = materialise(grams.join(own, F.col("gram") == F.col("_k"), "left").select("gram", "_v"), "grams-met")
    keys, kinds = [], []
    for n in range(ORDER, SHARED, -1):
        at = ORDER - n + 1
        keys.append(F.concat(F.substring("gram", at, n - 1), F.lit(_BACKOFF)))
        kinds.append(f"b{n}")
        if n > SHARED + 1:
            keys.append(F.substring("gram", at + 1, n - 1))
            kinds.append(f"v{n - 1}")
    steps = met.where("_v is null").select(
        "gram", F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), k.alias("key")) for kind, k in zip(kinds, keys))))
        .alias("_step")).select("gram", "_step.kind", "_step.key")
    found = steps.join(own, F.col("key") == F.col("_k"), "left").groupBy("gram").agg(
        *(F.max(F.when(F.col("kind") == kind, F.col("_v"))).alias(kind) for kind in kinds))
    ratio = F.lit(0.0)
    for n in range(SHARED + 1, ORDER + 1):  # from the shortest end to the longest
        ratio = F.coalesce(F.col(f"b{n}"), F.lit(0.0)) + (
            ratio if n == SHARED + 1 else F.coalesce(F.col(f"v{n - 1}"), ratio))
    return met.where("_v is not null").select("gram", F.col("_v").alias("ratio")).unionByName(
        found.select("gram", ratio.alias("ratio")))


# The same model from tables in memory: the definition that tests compare with.
def _shared_model(shared: dict) -> Callable[[str], float]:
    """Interpolated continuation probabilities of the orders for both classes."""
    counts = {n: dict(zip(t["gram"], t["any"].astype(float))) for n, t in shared.items()}
    sums: dict[int, dict[str, list[float]]] = {}
    for n, table in counts.items():
        sums[n] = {}
        for gram, c in table.items():
            s = sums[n].setdefault(gram[:-1], [0.0, 0.0])
            s[0] += c
            s[1] += 1
    size = len(counts[1]) + 1

    def p(gram: str) -> float:
        out = 1.0 / size
        for n in range(1, SHARED + 1):
            g = gram[-n:]
            s = sums[n].get(g[:-1])
            if s is None:
                break
            out = (max(counts[n].get(g, 0.0) - DISCOUNT, 0.0) + DISCOUNT * s[1] * out) / s[0]
        return out
    return p


def _tables(grams: dict, contexts: dict, shared: dict) -> tuple[dict[str, float], dict[str, float]]:
    """(log ratio of every kept n-gram, log ratio of the backoff weights of every context)."""
    lowest = _shared_model(shared)
    prob: dict[str, tuple[float, float]] = {}
    weight: dict[str, tuple[float, float, float, float]] = {}

    def both(gram: str) -> tuple[float, float]:
        """Class probabilities of a character behind a context of any length."""
        carry = (1.0, 1.0)
        while len(gram) > SHARED:
            found = prob.get(gram)
            if found is not None:
                return carry[0] * found[0], carry[1] * found[1]
            w = weight.get(gram[:-1])
            if w is not None:
                carry = carry[0] * w[2], carry[1] * w[3]
            gram = gram[1:]
        p = lowest(gram)
        return carry[0] * p, carry[1] * p

    for n in range(SHARED + 1, ORDER + 1):
        for h, t, o, kt, ko in contexts[n].itertuples(index=False):
            weight[h] = (t, o, 1 - kt / t if t else 1.0, 1 - ko / o if o else 1.0)
        found = {}
        for g, t, o in grams[n].itertuples(index=False):
            nt, no, bt, bo = weight[g[:-1]]
            lt, lo = both(g[1:])
            found[g] = ((max(t - DISCOUNT, 0.0) / nt if nt else 0.0) + bt * lt,
                        (max(o - DISCOUNT, 0.0) / no if no else 0.0) + bo * lo)
        prob.update(found)
    return ({g: math.log(t / o) for g, (t, o) in prob.items()},
            {h: math.log(w[2] / w[3]) for h, w in weight.items() if w[2] > 0 and w[3] > 0})


class Ratios:
    """Log ratios of words from tables in memory."""

    def __init__(self, grams: dict[str, float], backoff: dict[str, float]):
        self.grams, self.backoff = grams, backoff

    def word(self, word: str) -> float:
        m, out, grams, backoff = marked(word), 0.0, self.grams, self.backoff
        for k in range(len(word) + 1):
            g = m[k:k + ORDER]
            while len(g) > SHARED:
                found = grams.get(g)
                if found is not None:
                    out += found
                    break
                out += backoff.get(g[:-1], 0.0)
                g = g[1:]
        return out


def figures(ratios: np.ndarray, chars: np.ndarray) -> tuple[float, ...]:
    """The four figures of a text from its words' log ratios and numbers of characters."""
    n, w = len(ratios), min(WINDOW, len(ratios))
    r, c = np.concatenate([[0.0], np.cumsum(ratios)]), np.concatenate([[0.0], np.cumsum(chars)])
    best = ((r[w:] - r[:-w]) / (c[w:] - c[:-w])).max()
    top = np.partition(ratios, max(0, n - TOP))[-TOP:]
    return (float(r[-1] / c[-1]), float(best), float(top.sum()) / TOP,
            float(np.maximum(ratios - TELLING, 0).sum()) / n)


def text_figures_of(words: list[str], ratio: dict[str, float]) -> tuple[float, ...] | None:
    n = len(words)
    if not n:
        return None
    return figures(np.fromiter(map(ratio.__getitem__, words), dtype=np.float64, count=n),
                   np.fromiter(map(len, words), dtype=np.float64, count=n) + 1)


class MappedRatios:
    """Log ratios read from sorted files that Spark hands out; words not met
    lately are looked up many at a time."""

    def __init__(self, keys: str, values: str):
        self.names = keys, values
        self.keys = self.values = None
        self.known = _Recent(self.word)

    def __getstate__(self):
        return self.names

    def __setstate__(self, names):
        self.__init__(*names)

    def _look_up(self, grams: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(found, value or 0) of keys."""
        if self.keys is None:  # once per worker
            self.keys, self.values = (
                np.memmap(SparkFiles.get(name), dtype=kind, mode="r").view(np.ndarray)
                for name, kind in zip(self.names, (_KEY, "<f8")))
        wanted = np.array(grams, dtype=_KEY)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return found, np.where(found, self.values[at], 0.0)

    def _gram_ratios(self, grams: list[str]) -> np.ndarray:
        out, live = np.zeros(len(grams)), np.arange(len(grams))
        for n in range(ORDER, SHARED, -1):
            if not grams:
                break
            found, values = self._look_up(grams)
            out[live] += values
            live, grams = live[~found], [g for g, f in zip(grams, found.tolist()) if not f]
            if grams:
                out[live] += self._look_up([g[:-1] + _BACKOFF for g in grams])[1]
                grams = [g[1:] for g in grams]
        return out

    def _word_ratios(self, words: list[str]) -> np.ndarray:
        ids: dict[str, int] = defaultdict(count().__next__)
        at = [ids[m[k:k + ORDER]] for m in map(marked, words) for k in range(len(m) - ORDER + 1)]
        ends = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        return np.add.reduceat(self._gram_ratios(list(ids))[at], ends)

    def word(self, word: str) -> float:
        return float(self._word_ratios([word])[0])

    def figures_of(self, texts: Iterable[str]) -> Iterator[tuple[float, ...] | None]:
        held: list[list[str]] = []
        ratios: dict[str, float] = {}
        new: list[str] = []
        size = 0

        def flush() -> Iterator[tuple[float, ...] | None]:
            if new:
                for word, ratio in zip(new, self._word_ratios(new).tolist()):
                    ratios[word] = ratio
                    self.known.keep(word, ratio)
            for words in held:
                yield text_figures_of(words, ratios)
            for part in (held, ratios, new):
                part.clear()

        for text in texts:
            held.append(words_of(text))
            size += len(text)
            for word in set(held[-1]).difference(ratios):
                found = self.known.find(word)
                if found is None:
                    new.append(word)
                    found = 0.0  # until it is looked up
                ratios[word] = found
            if len(new) >= _NEW_WORDS or size >= _HELD_TEXT:
                yield from flush()
                size = 0
        yield from flush()


class _Recent(dict):
    """Log ratios of the words met last, in two generations of bounded size."""

    def __init__(self, ratio: Callable[[str], float]):
        super().__init__()
        self.ratio = ratio
        self.older: dict[str, float] = {}

    def __missing__(self, word: str) -> float:
        found = self.find(word)
        if found is None:
            found = self.ratio(word)
            self.keep(word, found)
        return found

    def find(self, word: str) -> float | None:
        found = self.get(word)
        if found is None:
            found = self.older.get(word)
            if found is not None:
                self.keep(word, found)
        return found

    def keep(self, word: str, found: float) -> None:
        if len(word) <= 64:
            if len(self) >= _HELD_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = found


def _code_kind(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<u4"


def _shard(limit: int):
    """(doc_id, mark, text) -> one row per ``limit`` characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        names = ["shard", "doc_ids", "marks", "sizes", "codes", "words"]
        ids: list = []
        marks: list[int] = []
        codes: list[np.ndarray] = []
        known: dict[str, int] = defaultdict(count().__next__)
        size, kind = 0, None

        def row() -> pa.RecordBatch:
            flat = np.concatenate(codes).astype(_code_kind(len(known)))
            cells = [uuid.uuid4().hex, ids, marks, [len(c) for c in codes], press.compress(flat.tobytes()), list(known)]
            kinds = [pa.string(), pa.list_(kind), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
                     pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=names)

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, mark, text in zip(*(batch.column(c) for c in range(3))):
                text = text.as_py()
                words = words_of(text)
                ids.append(doc_id.as_py())
                marks.append(mark.as_py())
                codes.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint32, count=len(words)))
                size += len(text) + 16
                if size >= limit:
                    yield row()
                    ids, marks, codes, known, size = [], [], [], defaultdict(count().__next__), 0
        if ids:
            yield row()
    return run


def _grams_of(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different n-grams in order of appearance, their places word by word, first place of each word)."""
    ids: dict[str, int] = defaultdict(count().__next__)
    at = [ids[m[k:k + ORDER]] for m in map(marked, words) for k in range(len(m) - ORDER + 1)]
    return list(ids), np.array(at, dtype=np.int64), np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]


def _shard_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, words) -> (shard, at, gram): the different n-grams of each shard."""
    for batch in batches:
        for shard, words in zip(batch.column(0).to_pylist(), batch.column(1)):
            grams = _grams_of(words.as_py())[0]
            for k in range(0, len(grams), _HELD_WORDS):
                some = grams[k:k + _HELD_WORDS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(some), pa.string()),
                     pa.array(np.arange(k, k + len(some), dtype=np.int32)), pa.array(some, pa.string())],
                    names=["shard", "at", "gram"])


def _shard_figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_ids, marks, sizes, codes, words, found) -> doc_id, row_mark and the four figures."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, marks = batch.column(0)[i].values, batch.column(1)[i].values
            sizes = batch.column(2)[i].values.to_numpy()
            rows: list[tuple] = [(None,) * 4] * len(sizes)
            if sizes.any():
                words, found = batch.column(4)[i].as_py(), batch.column(5)[i].values
                gram_ratio = np.zeros(len(found))
                gram_ratio[found.field(0).to_numpy()] = found.field(1).to_numpy()
                _, at, starts = _grams_of(words)
                ratio = np.add.reduceat(gram_ratio[at], starts)
                chars = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) + 1
                flat = np.frombuffer(zstandard.decompress(batch.column(3)[i].as_py()), dtype=_code_kind(len(words)))
                ends = np.cumsum(sizes, dtype=np.int64)
                rows = [figures(ratio[flat[e - n:e]], chars[flat[e - n:e]]) if n else r
                        for r, n, e in zip(rows, sizes.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [ids, marks, *(pa.array([r[k] for r in rows], pa.float64()) for k in range(4))],
                names=["doc_id", "row_mark", *_FIGURES])


def _mapped_figures(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = [f or (None,) * 4 for f in model.figures_of(t.as_py() for t in batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], pa.float64()) for k in range(4))],
                names=["doc_id", "row_mark", *_FIGURES])
    return run


def text_figures(docs: DataFrame, table: DataFrame, mapped_rows: int = MAPPED_ROWS,
                 shard_text: int = SHARD_TEXT) -> DataFrame:
    """doc_id, row_mark and the four figures (null without words) of every row."""
    src = docs.select("doc_id", row_mark().alias("_mark"), text_of().alias("_text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, row_mark bigint, " + ", ".join(f"{x} double" for x in _FIGURES)
    if table.count() <= mapped_rows:
        spark = docs.sparkSession
        shared = spark.sparkContext.broadcast(_write_model(spark, table))
        return materialise(src.mapInArrow(_mapped_figures(shared), out), "figures")
    shards = materialise(src.mapInArrow(
        _shard(shard_text), f"shard string, doc_ids array<{kind}>, marks array<bigint>, sizes array<int>, codes binary, "
                "words array<string>"), "shards")
    grams = shards.select("shard", "words").mapInArrow(_shard_grams, "shard string, at int, gram string")
    ratios = materialise(_gram_ratios(grams.select("gram").distinct(), table), "gram-ratios")
    found = grams.join(ratios, "gram").groupBy("shard").agg(F.collect_list(F.struct("at", "ratio")).alias("found"))
    return materialise(shards.join(found, "shard", "left").select(
        "doc_ids", "marks", "sizes", "codes", "words", "found").mapInArrow(_shard_figures, out), "figures")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept last) by Newton steps on the penalised log-likelihood."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - middle) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)), grad)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    out = w.copy()
    out[:-1] = w[:-1] / spread
    out[-1] = w[-1] - (w[:-1] * middle / spread).sum()
    return out


def _marks(labels: DataFrame, fit_rows: int) -> tuple[DataFrame, DataFrame]:
    """(training ids, fitting ids) with their labels, as written tables."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("_toxic"))
    fold = F.crc32(F.col("_id").cast("string")) % FOLDS
    train_ids = marks.where((fold != 0) & (fold != FOLDS - 1))
    fit_ids = marks.where(fold == FOLDS - 1).orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(fit_rows)
    return materialise(train_ids, "train-ids"), materialise(fit_ids, "fit-ids")


def _rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    side = small_side(ids)
    return docs.select("doc_id", text_of().alias("_text")).join(side, F.col("doc_id") == F.col("_id")).select(
        "_text", "_toxic")


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, row_mark for every row of ``docs``."""
    ship_package(docs.sparkSession)
    train_ids, fit_ids = _marks(labels, fit_rows)
    table = train(_rows(docs, train_ids))
    if table is None:
        scored = docs.select("doc_id", row_mark().alias("row_mark"), F.lit(0.0).alias("score"))
    else:
        rows = text_figures(docs, table)
        weights, empty = _fit(rows, fit_ids, fit_rows)
        z = F.lit(float(weights[-1]))
        for w, x in zip(weights[:-1], _FIGURES):
            z = z + F.lit(float(w)) * F.col(x)
        z = F.least(F.greatest(z, F.lit(-500.0)), F.lit(500.0))
        scored = rows.select("doc_id", "row_mark", F.coalesce(1 / (1 + F.exp(-z)), F.lit(empty)).alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "row_mark")


def _fit(rows: DataFrame, fit_ids: DataFrame, fit_rows: int) -> tuple[np.ndarray, float]:
    """(logistic weights, score of empty texts) from at most ``fit_rows`` rows with words."""
    side = small_side(fit_ids)
    xy = rows.where("x0 is not null").join(side, F.col("doc_id") == F.col("_id")).orderBy(
        F.md5(F.col("_id").cast("string")), "_id", "row_mark").limit(fit_rows).select(*_FIGURES, "_toxic").toPandas()
    y = xy["_toxic"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():  # no contrast to fit on: the telling words decide
        return np.array([0.0, 0.0, 1.0, 0.0, -TELLING]), 0.0
    return fit_logistic(xy[list(_FIGURES)].to_numpy(), y), float(y.mean())


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the rows predicted toxic.  Only the marks
    of those rows are written; the corpus meets them in one anti join, broadcast
    when they are small."""
    own_id, mark, row = free_names(docs, "_t_id", "_t_mark", "_t_row")
    toxic = materialise(score_toxicity(docs, labels).where("predicted = 1").select(
        F.col("doc_id").alias(own_id), F.col("row_mark").alias(mark)).distinct(), "toxic")
    marked_docs, side = docs.withColumn(row, row_mark()), small_side(toxic)
    return marked_docs.join(side, null_safe(marked_docs, side, [("doc_id", own_id), (row, mark)]), "left_anti").drop(row)
