from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tally.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, error int, code string, _w int"


def brute(rows, entries=256, rounds=4):
    """Lloyd rounds in Python's whole numbers."""
    kept = [(i, [math.floor(float(np.float32(x)) * 1024) for x in e], lab) for i, e, lab, *_ in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    n = max((sum(len(w) == s for _, w, _ in kept), s) for s in {len(w) for _, w, _ in kept} if s and s % 4 == 0)[1]
    kept = [r for r in kept if len(r[1]) == n]
    d = n // 4
    split = lambda w: [w[p * d:(p + 1) * d] for p in range(4)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[split(w)[p] for _, w, _ in first] for p in range(4)]

    def assign(w):
        out = []
        for p, x in enumerate(split(w)):
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p])))
        return out
    for _ in range(rounds):
        found = [defaultdict(list) for _ in range(4)]
        for _, w, _ in kept:
            for p, (_, k) in enumerate(assign(w)):
                found[p][k].append(split(w)[p])
        for p in range(4):
            for k, xs in found[p].items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    done = [(i, lab, assign(w)) for i, w, lab in kept]
    by = defaultdict(int)
    for _, lab, a in done:
        by[lab] += sum(x for x, _ in a)
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in a), sum(x for x, _ in a), by[lab], sha)
                   for i, lab, a in done), key=repr)


def messy():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], rng.choice([None, 1, 2, 3])) for i in range(330)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]                      # one vector very often
    rows += [(5, rows[5][1], 2), (5, rows[5][1], 2), (None, rows[9][1], 1), (None, None, 1)]
    rows += [(2000, None, 1), (2001, [1.0] * 7 + [None], 1), (2002, [float("nan")] * 8, 1),
             (2003, [float("inf")] * 8, 1), (2004, [], 1), (2005, [1.0] * 4, 1), (2006, [1.0] * 7, None),
             (2007, [-0.0004] * 8, 1), (2008, [-1e3] * 8, 4)]
    return [(*r, 7, "clash", 8) for r in rows]


def test_messy_rows_equal_brute_force(spark):
    rows = messy()
    got = V.code_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_fewer_rows_than_entries_and_one_row(spark):
    for rows in (messy()[:11], messy()[:1]):
        got = V.code_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
        assert all(r["error"] == 0 for r in got)


def test_empty_tables_and_tables_without_a_vector(spark):
    assert V.code_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert V.code_vectors(spark.createDataFrame([(1, None, 1, 1, "", 1), (2, [1.0], 1, 1, "", 1)], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [10, 2 ** 20, 2 ** 27, 2 ** 28 - 1])
def test_products_of_limbs_are_exact(size):
    rng = np.random.default_rng(size)
    x, c = rng.integers(-size, size, (40, 16)), rng.integers(-size, size, (9, 16))
    x[0], c[0], x[1], c[1] = size, -size, -size, size
    want = [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in c] for r in x]
    assert V.exact_products(x, c).tolist() == want
    index, far = V.nearest(x, c)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in c] for r in x]
    assert index.tolist() == [r.index(min(r)) for r in exact] and far.tolist() == [min(r) for r in exact]


def test_limbs_stay_below_the_mantissa():
    for length in (1, 2, 3, 16, 17, 1000, 5000):
        assert 2 * V.limb_bits(length) + math.log2(length) <= 53
    values = np.array([-2 ** 62, 2 ** 62, -1, 0, 1, 2 ** 40 + 3])
    bits = V.limb_bits(16)
    parts = V.limbs(values, bits)
    assert len(parts) > 1 and all(np.abs(p).max() <= 2 ** bits for p in parts)
    assert [sum(int(p[i]) << (bits * j) for j, p in enumerate(parts)) for i in range(6)] == values.tolist()


def test_distances_beyond_a_long_are_refused(spark):
    rows = [(1, [3e38] * 8, 1, 1, "", 1), (2, [-3e38] * 8, 1, 1, "", 1)]
    with pytest.raises(OverflowError):
        V.code_vectors(spark.createDataFrame(rows, SCHEMA))
