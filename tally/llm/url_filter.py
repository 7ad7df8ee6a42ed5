"""URL filter over a sorted digest array (operator 10).

A rule is (host, path, verdict).  It fits its host and all subdomains when
the url's path starts with the rule's path; of the fitting rules the longest
(host + path; then the longer host) decides, otherwise the filter's default.

The rules become one file: 64-bit xxhash keys in ascending order, string
offsets, and the full strings with their verdicts.  It is written to the
shared checkpoint folder and handed to the executors with
``SparkContext.addFile``; every Python worker maps it into memory
(``numpy.memmap``), so its pages are shared by the workers of a machine
and nothing is parsed.  For a batch of urls all candidate strings (host
suffixes x the path lengths that occur in rules) are hashed, probed with
one vectorised binary search, and every hit is confirmed against the stored
string, so a digest collision cannot decide.

Defined results: a null url, or one without ``://``, has an empty host and
path and gets the default; empty hosts fit no rule; repeated rows are
judged each; an empty table gives no rows; other columns are not read.
Rules with the same host and path: the last one counts.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import publish, ship_package

# The contract's rules.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
DEFAULT = "allow"

_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
_SCHEMA = "host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as defined above."""
    if url is None:
        return "", ""
    _, sep, rest = url.partition("://")
    if not sep:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return host.translate(_UPPER), path


class DigestArray:
    """Sorted 64-bit keys with their full strings, readable from one mapped file."""

    def __init__(self, buffer: np.ndarray):
        n, m, self.host_labels = (int(x) for x in buffer[:24].view("<u8"))
        at = 24
        self.keys = buffer[at:at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = buffer[at:at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.path_lengths = [int(x) for x in buffer[at:at + 8 * m].view("<u8")]
        at += 8 * m
        self.strings = buffer[at:]

    @classmethod
    def open(cls, path: str) -> DigestArray:
        return cls(np.memmap(path, dtype=np.uint8, mode="r"))

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
        whole = {(h.translate(_UPPER), p): v for h, p, v in rules}
        rows = sorted((xxhash.xxh64_intdigest((h + "/" + p).encode()), h, p, v)
                      for (h, p), v in whole.items())
        blobs = ["\x00".join(r[1:]).encode() for r in rows]
        offsets = np.cumsum([0, *map(len, blobs)]).astype("<u8")
        lengths = np.array(sorted({len(r[2]) for r in rows}), dtype="<u8")
        labels = max((h.count(".") + 1 for _, h, _, _ in rows), default=0)
        head = np.array([len(rows), len(lengths), labels], dtype="<u8")
        keys = np.array([r[0] for r in rows], dtype="<u8")
        return b"".join([head.tobytes(), keys.tobytes(), offsets.tobytes(), lengths.tobytes(), *blobs])

    def entry(self, i: int) -> tuple[str, str, str]:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        return tuple(self.strings[a:b].tobytes().decode().split("\x00"))

    def probe(self, candidates: list[tuple[int, str, str]]) -> dict[int, tuple[str, str, str]]:
        """{row: rule} for candidates (row, host, path): the longest confirmed rule."""
        best: dict[int, tuple[str, str, str]] = {}
        if not candidates or not len(self.keys):
            return best
        digests = np.fromiter((xxhash.xxh64_intdigest((h + "/" + p).encode()) for _, h, p in candidates),
                              dtype=np.uint64, count=len(candidates))
        first = np.searchsorted(self.keys, digests, side="left")
        hit = (first < len(self.keys)) & (self.keys[np.minimum(first, len(self.keys) - 1)] == digests)
        for c in np.flatnonzero(hit).tolist():
            row, host, path = candidates[c]
            i = int(first[c])
            while i < len(self.keys) and self.keys[i] == digests[c]:
                h, p, v = self.entry(i)
                if (h, p) == (host, path):
                    old = best.get(row)
                    if old is None or (len(h) + len(p), len(h)) > (len(old[0]) + len(old[1]), len(old[0])):
                        best[row] = (h, p, v)
                i += 1
        return best

    def _suffixes(self, host: str) -> list[str]:
        """The host's last labels, as many as a rule has at most: a rule's host has no
        more, so longer suffixes are not built."""
        out, at = [], len(host)
        for _ in range(self.host_labels if host else 0):
            at = host.rfind(".", 0, at)
            if at + 1 < len(host):
                out.append(host[at + 1:])
            if at < 0:
                break
        return out

    def judge(self, urls: list[str | None], default: str) -> list[tuple[str, str, str | None, str]]:
        parsed = [split_url(u) for u in urls]
        candidates = []
        for row, (host, path) in enumerate(parsed):
            suffixes = self._suffixes(host)
            for n in self.path_lengths:
                if n <= len(path):
                    candidates += [(row, s, path[:n]) for s in suffixes]
        found = self.probe(candidates)
        return [(h, p, found[i][0] + found[i][1], found[i][2]) if i in found else (h, p, None, default)
                for i, (h, p) in enumerate(parsed)]


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES,
                default: str = DEFAULT, id_column: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict for every row of ``pages``."""
    spark, blob = pages.sparkSession, DigestArray.pack(rules)
    ship_package(spark)
    name = f"url-rules-{hashlib.sha256(blob).hexdigest()[:16]}-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(publish(spark, name, blob))
    src = pages.select(id_column, "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray.open(SparkFiles.get(name))
        for batch in batches:
            judged = array.judge(batch.column(1).to_pylist(), default)
            host, path, rule, verdict = zip(*judged) if judged else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.string()) for x in (host, path, rule, verdict))],
                names=[id_column, "host", "path", "rule", "verdict"])

    id_type = src.schema[id_column].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_column}` {id_type}, {_SCHEMA}")
