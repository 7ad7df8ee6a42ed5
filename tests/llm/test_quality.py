from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import CHECK_SF
from llm_data import empty_docs, messy_docs, messy_rows, words
from tally.llm import quality as Q

LABELS = "doc_id bigint, quality int, toxic int, score double, text string"


def kind(b: int) -> int:
    if b >= 128:
        return 1
    return next((i for i, cs in enumerate(Q.CLASS_CHARACTERS) if chr(b) in cs), Q.CLASSES - 1)


def plain_counts(text: str) -> Counter:
    """The terms of a text, one by one."""
    b = [10, *text.encode(), 10]
    out = Counter()
    for x, y, z in zip(b, b[1:], b[2:]):
        out[((x << 16 | y << 8 | z) * 2654435761 % 2 ** 32) >> 20] += 1
        out[Q.CONTENT + kind(x) * 256 + kind(y) * 16 + kind(z)] += 1
    for base, items in ((Q.CONTENT + Q.FORM, list(zip(w := Q._WORD.findall(text), w[1:]))),
                        (Q.CONTENT + Q.FORM + Q.LEVELS, text.split("\n"))):
        seen = Counter()
        for i in items:
            out[base + min(seen[i].bit_length(), Q.LEVELS - 1)] += 1
            seen[i] += 1
    return out


def held_out(d) -> bool:
    return d is not None and zlib.crc32(str(d).encode()) % 3 == 1


def plain_scores(rows, labels, neighbours, sharpness):
    """The whole operator on dense rows with a full singular value decomposition."""
    texts = [r[1] or "" for r in rows]
    told = [t for t in texts if t]
    df = Counter(k for t in told for k in plain_counts(t) if k < Q.CONTENT + Q.FORM)
    idf = [math.log((len(told) + 1) / (df[k] + 1)) + 1 for k in range(Q.CONTENT + Q.FORM)]

    def vector(t):
        x = np.zeros(Q.TERMS)
        for k, n in plain_counts(t).items():
            x[k] = math.sqrt(n) * (idf[k] if k < len(idf) else 1)
        for a, b in ((0, Q.CONTENT), (Q.CONTENT, Q.CONTENT + Q.FORM), (Q.CONTENT + Q.FORM, Q.TERMS)):
            x[a:b] /= np.linalg.norm(x[a:b]) or 1
        return x
    marks = {}
    for d, q, *_ in labels:
        if d is not None and q in (0, 1) and not held_out(d):
            marks.setdefault(d, set()).add(q)
    voters = {d: min(r[1] for r in rows if r[0] == d and r[1]) for d, qs in marks.items()
              if len(qs) == 1 and any(r[0] == d and r[1] for r in rows)}
    x = np.stack([vector(t) for t in voters.values()])
    y = np.array([min(marks[d]) for d in voters])
    _, s, v = np.linalg.svd(x, full_matrices=False)
    v = v[s > 1e-9 * s[0]]
    unit = lambda a: a / np.linalg.norm(a)
    mean = (x @ v.T).mean(axis=0)
    around = [unit(a @ v.T - mean) for a in x]
    out = []
    for t in texts:
        score = y.mean()
        if t:
            near = sorted(((unit(vector(t) @ v.T - mean) @ a, q) for a, q in zip(around, y)), reverse=True)[:neighbours]
            w = [max(c, 0) ** sharpness for c, _ in near]
            score = sum(a * q for a, (_, q) in zip(w, near)) / sum(w) if sum(w) else score
        out.append(score)
    return out


def test_term_counts_equal_the_plain_definition(monkeypatch):
    rng = random.Random(1)
    texts = ["a", "日本 語!\n\n| x", words(rng, 300) + " A b " * 40 + "\nx\nx\nx", "x " * 1000, "\x00\x7f§"]
    for piece in (7, Q.PIECE):
        monkeypatch.setattr(Q, "PIECE", piece)
        for t in texts:
            got = Q.term_counts(t)
            assert {i: int(n) for i, n in enumerate(got) if n} == dict(plain_counts(t))


def test_scores_equal_brute_force_on_messy_rows(spark):
    rng = random.Random(3)
    good = [(100 + i, words(rng, 60)) for i in range(25)]
    bad = [(200 + i, " | ".join(words(rng, 3).upper() for _ in range(15))) for i in range(25)]
    rows = [*messy_rows(), *((d, t, None, None, 1, 7, True, 1, "x", "x") for d, t in good + bad)]
    labels = [(d, 1, None, 0.5, "x") for d, _ in good] + [(d, 0, 1, 0.5, "x") for d, _ in bad]
    labels += [(1, 1, 0, 0.0, ""), (2, None, 0, 0.0, ""), (4, 0, 0, 0.0, ""), (4, 1, 0, 0.0, ""), (None, 1, 0, 0.0, ""),
               (5, 1, 0, 0.0, ""), (999, 1, 0, 0.0, "")]
    docs = spark.createDataFrame(rows, messy_docs(spark).schema).repartition(3)
    got = Q.score_quality(docs, spark.createDataFrame(labels, LABELS), rank=1000, neighbours=5, sharpness=2)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    want = sorted(((r[0], held_out(r[0]), s) for r, s in zip(rows, plain_scores(rows, labels, 5, 2))), key=repr)
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    assert [r[:2] for r in found] == [r[:2] for r in want]
    by = lambda rs: sorted((repr(r[0]), round(r[2], 3)) for r in rs)
    assert by(found) == by(want)
    assert all(r[3] == int(r[2] >= 0.5) for r in found)


def test_subspace_iteration_finds_the_leading_directions():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(200, 40)) * 0.9 ** np.arange(40)).astype(np.float32)
    space = Q.latent_space(x, np.ones(0), rank=10, rounds=12)
    _, _, v = np.linalg.svd(x, full_matrices=False)
    assert np.abs(np.linalg.svd(space.directions.T @ v[:10].T, compute_uv=False) - 1).max() < 1e-2


def test_votes_equal_plain_loops():
    rng = np.random.default_rng(4)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    vs, qs, y = unit(rng.normal(size=(50, 6))), unit(rng.normal(size=(20, 6))), rng.integers(0, 2, 50)
    got = Q.Voters(vs, y, 7, 4).vote(qs)
    for q, s in zip(qs, got):
        near = sorted(((q @ v, i) for i, v in enumerate(vs)), reverse=True)[:7]
        w = [max(c, 0) ** 4 for c, _ in near]
        assert s == pytest.approx(sum(a * y[i] for a, (_, i) in zip(w, near)) / sum(w))
    assert Q.Voters(vs[:0], y[:0]).vote(qs).tolist() == [0.5] * 20


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{CHECK_SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.score_quality(docs, labels).where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert got >= 0.95


def test_no_labels_and_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert Q.score_quality(empty_docs(spark), none).collect() == []
    got = Q.score_quality(messy_docs(spark), none).collect()
    assert len(got) == len(messy_rows()) and {(r["score"], r["predicted"]) for r in got} == {(0.5, 1)}
    one = spark.createDataFrame([(1, 0, 0, 0.0, "")], LABELS)
    assert {r["predicted"] for r in Q.score_quality(messy_docs(spark), one).where("doc_id = 1").collect()} == {0}
    assert Q.score_quality(empty_docs(spark), one).collect() == []
