"""Secret scan: fixed patterns and dictionary-primed zstandard novelty (operator 1).

Base kinds (fixed patterns, leftmost non-overlapping per kind): ``assign``,
``access`` and ``hex``.

Novelty.  Runs of key characters are parted at ``=`` (padding at the end
stays), so that a name in front of a value is its context.  A part of
``LEAST`` or more characters is a candidate if a sensitive word (password,
auth, credential, ...) ends in front of it, in its run or at most ``REACH``
characters before the run, or if only a line break with its indent, quotes or
comment marks parts it from a candidate of the line before: lines of one key
are one block.  It may lie in a base span.  The text around the block
(``AROUND`` characters on both sides) is compressed by zstandard, primed with
a dictionary of common code identifiers, once with and once without the
candidate.  The difference is its marginal cost: a string that repeats what
is near it (or a line of its own block) or is made of identifiers costs about
half a byte per character, a random one about a byte.  Candidates with at
least ``NOVELTY`` bytes per character become spans of kind ``novel``, whatever
characters they are made of.  Costs are whole bytes, so they tell nothing
about strings shorter than ``LEAST``.

One pass over the documents in Arrow batches, no shuffle; a task holds one
batch.  The dictionary is a constant, so nothing is broadcast.

Defined results: a null text is empty and has no spans; every row is
scanned by itself, so repeated rows give repeated results; whole texts are
scanned whatever their length; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import ship_package, text_of

# The contract's patterns and smallest lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KINDS = ("assign", "access", "hex", "novel")

RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
PART = re.compile(r"[A-Za-z0-9+/_.-]+(?:=+$)?")
NEXT_LINE = re.compile(r"""[\x20\t"',;+\\]*\r?\n[\x20\t"'#*/>|+-]*""")
LEAST = 8
SENSITIVE = re.compile(
    r"passw|passphrase|pwd|secret|token|api.?key|private.?key|access.?key|credential|auth|bearer|"
    r"signature|session.?id|license.?key|certificate|connection.?string",
    re.IGNORECASE | re.ASCII)
REACH = 64
AROUND = 512
NOVELTY = 0.8

IDENTIFIERS = """
import from return class def self function const var let public private protected static final void
int long float double string boolean char byte array list dict map set object null none true false
if else elif for while do switch case break continue try except catch finally throw raise with as in
is not and or new delete this super extends implements interface abstract package module export
default async await yield lambda print println printf format length size count index value values
key keys item items name names type types file path url uri host port user username email address
id uuid timestamp date time year month day hour minute second millis config configuration settings
options params parameters args kwargs environment request response header headers body content
payload message error exception warning debug info logger logging level status code result results
output input data database table column row record query select insert update where order group by
limit offset join left right inner outer client server connection session context thread process
queue worker task job event handler callback listener observer factory builder manager service
controller repository model view template component property attribute method parameter variable
example sample test tests testing localhost http https www com org net json xml yaml yml html css
js py java cpp txt csv log md readme version release license copyright author description
password passwd secret token api_key apikey access_key private_key public_key client_id client_secret
authorization bearer basic credential credentials certificate signature
""".split()
_DICTIONARY = ("_".join(IDENTIFIERS) + " " + " ".join(IDENTIFIERS)).encode()
_USUAL = " ".join(IDENTIFIERS[::3]).encode()[:AROUND]
_press: zstandard.ZstdCompressor | None = None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in code points."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= HEX_MIN]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def marginal_bytes(candidate: str, before: str, after: str) -> int:
    """Bytes that ``candidate`` adds to its compressed surroundings."""
    global _press
    if _press is None:  # once per worker
        _press = zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(_DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False)
    head = before.encode("utf-8", "replace")
    tail = after.encode("utf-8", "replace")
    if len(head) + len(tail) < AROUND:  # too little text to know what is usual
        head = _USUAL + head
    return len(_press.compress(head + candidate.encode() + tail)) - len(_press.compress(head + tail))


def candidates(text: str) -> Iterator[list[tuple[int, int]]]:
    """Blocks of strings in a sensitive context: those of adjacent lines together."""
    words = [m.end() for m in SENSITIVE.finditer(text)]
    if not words:
        return
    block: list[tuple[int, int]] = []
    w = 0
    for m in RUN.finditer(text, words[0]):
        for part in PART.finditer(m.group()):
            start, end = m.start() + part.start(), m.start() + part.end()
            if end - start < LEAST:
                continue
            while w < len(words) and words[w] <= start:
                w += 1
            follows = bool(block) and NEXT_LINE.fullmatch(text, block[-1][1], start) is not None
            if not follows:
                if block:
                    yield block
                block = []
                if not w or m.start() - words[w - 1] > REACH:
                    continue
            block.append((start, end))
    if block:
        yield block


def novel_spans(text: str, novelty: float = NOVELTY) -> list[tuple[int, int, str]]:
    """Incompressible strings in a sensitive context."""
    out: list[tuple[int, int, str]] = []
    for block in candidates(text):
        copies = Counter(text[start:end] for start, end in block)
        for start, end in block:
            run = text[start:end]
            # lines of one key tell nothing about each other, unless they repeat
            first, last = (block[0][0], block[-1][1]) if copies[run] == 1 else (start, end)
            cost = marginal_bytes(run, text[max(0, first - AROUND):first], text[last:last + AROUND])
            if cost >= novelty * len(run):
                out.append((start, end, "novel"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        texts = batch.column(1)
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            base = base_spans(text)
            more = novel_spans(text)
            kinds = [k for _, _, k in base]
            row = (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                   hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more))
            for column, value in zip(out, row):
                column.append(value)
        kinds_of = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds_of))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel per row."""
    ship_package(docs.sparkSession)
    src = docs.select("doc_id", text_of().alias("_text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_scan, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
                                 "base_sha256 string, spans string, n_novel bigint")
