"""SentencePiece encoding and decoding as a weighted transducer (operator 7).

A model file is compiled once per worker into a weighted finite-state
transducer over the tropical semiring:

* normaliser: a space becomes U+2581, with one more in front of a non-empty
  text (models with a character map are refused);
* pieces: one arc per vocabulary piece;
* byte fallback: a character that no piece covers becomes its UTF-8 bytes.

An input is composed with the transducer as a lattice over its positions and
the shortest path is its encoding.  For a unigram model an arc weighs the
negative score of its piece.  For a BPE model an arc weighs 0 or infinity,
depending on the piece before it: two neighbours are admissible when merging
their joined text by rank gives the same two pieces.  A path of admissible
neighbours is the merge result of its text, and each prefix has exactly one,
so a position has one state of finite weight and the search is linear.

No piece has U+2581 behind another character, so the lattice falls apart in
front of every run of U+2581 (and around characters of no piece); the pieces
of such a segment are remembered in a bounded table per worker.

The corpus is read in Arrow batches without a shuffle.  The model file's
bytes (half a MB) are broadcast.

Defined results: a null or empty text has no pieces and decodes to the empty
text; every row is encoded by itself; whole texts are encoded; an empty
table gives no rows; other columns are not read.  Decoding gives the text
back, except that U+2581 in a text comes back as a space.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_of

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 200_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


class PieceTransducer:
    """A compiled model: ``encode`` text to piece ids, ``decode`` ids to text."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are compiled")
        if proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are compiled")
        if any(p.type == _USER for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not compiled")
        self.bpe = proto.trainer_spec.model_type == 2
        self.prefix = norm.add_dummy_prefix
        self.text_of = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.letters = {c for p in self.ids for c in p}
        self.apart = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        alone = "" if "\n" in self.letters else "\n"
        self.segments = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))
        self.low = min(self.score) - 10
        self.halves: dict[int, tuple[int, int]] = {}
        if self.bpe:  # a piece that merging does not reach is on no path
            whole = dict(self.ids)
            for p, k in whole.items():
                undone: list[tuple[str, str]] = []
                if len(p) > 1 and self._merged(p, undone) != [p]:
                    del self.ids[p]
                elif len(p) > 1:
                    self.halves[k] = tuple(whole[x] for x in undone[-1])
        self.fits: dict[int, bool] = {}
        self.lead = {p[:n]: -2 for p in self.ids for n in range(1, len(p))}
        self.lead.update(self.ids)
        self.known = _Recent(self.shortest_path)
        # a word stands for itself behind a space, or, if it begins with a line feed, without one
        self.plain = self.apart and self.prefix and bool(alone)
        self.words = _Recent(lambda w: self.shortest_path(w[0]) + (self.shortest_path(w[1:]) if w[1:] else [])
                             if w[:1] == "\n" else self.shortest_path(SPACE + w))
        # how a piece reads; bytes from 0x80 on are parts of a character
        self.reads = [p if t == _NORMAL else " ⁇ " if t == _UNKNOWN else "" for p, t in
                      zip(self.text_of, self.types)]
        for i, b in self.byte_of.items():
            self.reads[i] = chr(b)
        self.partial = np.zeros(len(self.types), dtype=bool)
        self.partial[[i for i, b in self.byte_of.items() if b >= 0x80]] = True

    def _merged(self, text: str, done: list[tuple[str, str]] | None = None) -> list[str]:
        """Merge by rank: the best-scored neighbours first, leftmost among equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (k := self.ids.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-self.score[k], i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, whole = heapq.heappop(queue)
            if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != whole:
                continue
            if done is not None:
                done.append((parts[i], parts[j]))
            parts[i], parts[j] = whole, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def _admissible(self, left: int, right: int) -> bool:
        """Whether merging the joined text gives these two pieces.

        The merges of both are undone, the later one first; the pair fails if
        the two parts that touch would have merged before the one undone."""
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            found = self._fit(left, right)
            if len(self.fits) >= 2 * REMEMBERED:
                self.fits.clear()
            self.fits[key] = found
        return found

    def _fit(self, a: int, b: int) -> bool:
        text, ids, halves, score = self.text_of, self.ids, self.halves, self.score
        if SPACE * 2 in text[a] + text[b]:  # runs of U+2581 share one rank
            return self._merged(text[a] + text[b]) == [text[a], text[b]]
        bound, equal = float("-inf"), False
        while True:
            k = ids.get(text[a] + text[b])
            if k is not None and (score[k] > bound or equal and score[k] == bound):
                return False
            late_a, late_b = a in halves, b in halves
            if not late_a and not late_b:
                return True
            if late_a and (not late_b or score[a] < score[b]):
                bound, equal = score[a], False
                a = halves[a][1]
            else:  # of equal ranks the left one was merged first
                bound, equal = score[b], True
                b = halves[b][0]

    def _fallback(self, letter: str) -> tuple[int, ...]:
        if not self.byte_ids:
            return (self.unknown,)
        return tuple(self.byte_ids[b] for b in letter.encode("utf-8", "surrogatepass"))

    def shortest_path(self, segment: str) -> list[int]:
        """Piece ids on the shortest path through the composed lattice."""
        path = self._zero_path(segment) if self.bpe else self._least_path(segment)
        out: list[int] = []
        for i, k in path:
            if k >= 0:
                out.append(k)
            else:
                out.extend(self._fallback(segment[i]))
        return out

    def _arcs(self, segment: str, i: int) -> list[tuple[int, int, int]]:
        """Arcs (start, end, piece) out of a position, longest last; -1 is the fallback."""
        lead, arcs = self.lead, []
        for j in range(i + 1, len(segment) + 1):
            k = lead.get(segment[i:j])
            if k is None:
                break
            if k >= 0:
                arcs.append((i, j, k))
        if not arcs or arcs[0][1] != i + 1:
            arcs.insert(0, (i, i + 1, -1))
        return arcs

    def _zero_path(self, segment: str) -> list[tuple[int, int]]:
        """All finite paths weigh 0, so best-first search is depth-first over
        admissible arcs; states found without a way to the end are not tried again."""
        n, fits, dead = len(segment), self.fits, set()
        path: list[tuple[int, int, int]] = []
        open_arcs = [self._arcs(segment, 0)]
        while True:
            at = path[-1] if path else (0, 0, -1)
            arcs, p = open_arcs[-1], at[2]
            while arcs:
                arc = arcs.pop()
                k = arc[2]
                if p >= 0 and k >= 0:
                    fit = fits.get(p << 32 | k)
                    if not (self._admissible(p, k) if fit is None else fit):
                        continue
                if dead and arc[1:] in dead:
                    continue
                path.append(arc)
                if arc[1] == n:
                    return [(i, k) for i, _, k in path]
                open_arcs.append(self._arcs(segment, arc[1]))
                break
            else:
                dead.add(at[1:])
                open_arcs.pop()
                path.pop()

    def _least_path(self, segment: str) -> list[tuple[int, int]]:
        """Dynamic programming over positions: the least sum of negative scores."""
        n = len(segment)
        cost = [0.0] + [float("inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for i in range(n):
            for _, j, k in self._arcs(segment, i):
                weight = cost[i] - (self.score[k] if k >= 0 else self.low)
                if weight < cost[j]:
                    cost[j], back[j] = weight, (i, k)
        path = []
        while n:
            path.append(back[n])
            n = back[n][0]
        return path[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if self.plain and text[0] != " " and text[-1] != " ":
            spaced = text.replace("\n", " \n")
            if "  " not in spaced and SPACE not in text:  # every space stands before one word
                return np.frombuffer(b"".join(map(self.words.__getitem__, spaced.split(" "))), np.int32)
        norm = text.replace(" ", SPACE)
        if self.prefix:
            norm = SPACE + norm
        segments = self.segments.findall(norm) if self.apart else [norm]
        return np.frombuffer(b"".join(map(self.known.__getitem__, segments)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        reads = self.reads
        if not self.partial[ids].any():
            text = "".join(map(reads.__getitem__, ids.tolist()))
        else:
            parts: list[str] = []
            held = bytearray()
            for i in ids.tolist():
                if (b := self.byte_of.get(i)) is not None:
                    held.append(b)
                    continue
                if held:
                    parts.append(held.decode("utf-8", "replace"))
                    held.clear()
                parts.append(reads[i])
            parts.append(held.decode("utf-8", "replace"))
            text = "".join(parts)
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


class _Recent(dict):
    """Packed piece ids of the segments met last: two generations of at most
    ``REMEMBERED`` entries; what is met again moves to the younger one."""

    def __init__(self, path: Callable[[str], list[int]]):
        super().__init__()
        self.path = path
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = array("i", self.path(segment)).tobytes()
        if len(segment) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[segment] = found
        return found


class ModelFile:
    """A model's bytes; broadcast, they are compiled once per worker, and the
    worker drops what it has compiled with the broadcast."""

    def __init__(self, model: bytes):
        self.model = model
        self._codec: PieceTransducer | None = None

    def __getstate__(self):
        return self.model

    def __setstate__(self, model):
        self.__init__(model)

    @property
    def codec(self) -> PieceTransducer:
        if self._codec is None:
            self._codec = PieceTransducer(self.model)
        return self._codec


def _shared(df: DataFrame, model_path: str):
    ship_package(df.sparkSession)
    with open(model_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(ModelFile(f.read()))


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for batch in batches:
            texts = batch.column(1)
            parts, counts, decoded = [], [], []
            start = held = 0
            for i in range(batch.num_rows):
                ids = codec.encode(texts[i].as_py())
                parts.append(ids)
                counts.append(len(ids))
                held += len(ids)
                decoded.append(codec.decode(ids))
                if held > 4_000_000:
                    yield _batch(batch, start, parts, counts, decoded)
                    parts, counts, decoded = [], [], []
                    start, held = i + 1, 0
            if parts or not batch.num_rows:
                yield _batch(batch, start, parts, counts, decoded)
    return run


def _batch(batch: pa.RecordBatch, start: int, parts: list[np.ndarray], counts: list[int],
           decoded: list[str]) -> pa.RecordBatch:
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    ends = np.cumsum([0, *counts]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).slice(start, len(counts)), pa.array(counts, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(decoded, pa.string())],
        names=["doc_id", "n_pieces", "ids", "decoded"])


def encode_corpus(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_pieces, ids, decoded for every row of ``docs``."""
    shared = _shared(docs, model_path)
    src = docs.select("doc_id", text_of().alias("_text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(
        _encode(shared), f"doc_id {kind}, n_pieces bigint, ids array<int>, decoded string")


def decode_corpus(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, text from piece ids (doc_id, ids); null ids give the empty text."""
    shared = _shared(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for batch in batches:
            ids = batch.column(1)
            texts = [codec.decode(np.array(ids[i].as_py() or [], dtype=np.int32))
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    src = encoded.select("doc_id", F.col("ids").cast("array<int>"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text string")
