from __future__ import annotations

import math
import pickle
import random

import numpy as np
import pytest

from tally.llm import topk_search as K

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int"


def brute(rows, k=10):
    whole = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            whole[(i, tuple(math.floor(float(np.float32(x)) * 1024) for x in e))] = None
    out = []
    for q, v in whole:
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in whole if c != q and len(w) == len(v))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", [dict(tree_rows=60, page=8, fanout=3, query_block=2), dict()])
def test_equal_brute_force_with_ties_nulls_and_repeats(spark, shape):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 0, 1) for i in range(400)]
    rows += [(1000 + i, rows[7][1], None, 1) for i in range(90)]                # one vector many times
    rows += [(2000, rows[7][1], 0, 1), (2000, rows[7][1], 0, 1), (2100, [0.0] * 6, 0, 1)]
    rows += [(3000, None, 0, 1), (None, [1.0] * 6, 0, 1), (3100, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, 1),
             (3200, [float("nan")] * 6, 0, 1), (3300, [float("inf")] * 6, 0, 1)]
    rows += [(4000, [1.0, 2.0], 0, 1), (4001, [3.0, -1.0], 0, 1), (5000, [], 0, 1), (5001, [], 0, 1)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), **shape).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_bounds_save_distance_computations():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 8)) * 3000
    points = np.concatenate([c + rng.normal(size=(100, 8)) * 20 for c in centres]).astype(np.int64)
    tree = K.MTree(np.arange(len(points)), points, page=32, fanout=8)
    opened = 0
    rows = tree.rows

    class Counting(list):
        def __getitem__(self, i):
            nonlocal opened
            opened += 1
            return rows[i]

    tree.rows = Counting(rows)
    q = points[5]
    ids, scores = tree.search(q, 5, 10)
    value = points @ q
    best = sorted((-s, i) for i, s in enumerate(value.tolist()) if i != 5)[:10]
    assert list(zip((-scores).tolist(), ids.tolist())) == best
    assert opened < sum(a < b for a, b in rows) / 2


def test_empty_and_no_queries(spark):
    assert K.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert K.top_k(spark.createDataFrame([(1, [1.0], 0, 1)], SCHEMA)).count() == 0
    assert K.top_k(spark.createDataFrame([(100, [1.0], 0, 1)], SCHEMA)).count() == 0


def test_floors_keep_all_that_reach_them():
    rng = np.random.default_rng(2)
    points = rng.integers(-50, 50, size=(600, 5))
    tree = K.MTree(np.arange(600), points, page=16, fanout=4)
    for q in points[:30]:
        ids, scores = tree.search(q, -1, 10)
        for floor in (int(scores[4]), int(scores[0]), int(scores[0]) + 1):
            got = tree.search(q, -1, 10, floor)
            reach = [(i, s) for i, s in zip(ids.tolist(), scores.tolist()) if s >= floor]
            assert [(i, s) for i, s in zip(got[0].tolist(), got[1].tolist()) if s >= floor] == reach


def test_floors_and_cells_save_products_on_clustered_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 4000
    points = np.concatenate([c + rng.normal(size=(200, 16)) * 30 for c in centres]).astype(np.int64)
    trees = [K.MTree(np.arange(200) + 200 * i, points[200 * i:200 * i + 200], page=32) for i in range(12)]
    q = points[3]
    _, scores = trees[0].search(q, 3, 10)
    for t in trees[1:]:
        t.search(q, 3, 10, int(scores.min()))
    assert sum(t.products for t in trees) < 0.3 * len(points)


def test_every_tree_is_a_task(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], 0, 1) for i in range(900)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), tree_rows=100)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_pages_meet_no_block_in_a_row(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], 0, 1) for i in range(600)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), tree_rows=50)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    points = np.random.default_rng(8).integers(-1024, 1024, size=(3000, 64))
    assert len(pickle.dumps(K.MTree(np.arange(3000), points))) < points.nbytes / 2


@pytest.mark.parametrize("groves", [1, 3, K.GROVES])
def test_groves_of_several_trees_give_the_same(spark, monkeypatch, groves):
    monkeypatch.setattr(K, "GROVES", groves)
    monkeypatch.setattr(K, "GROVE_BYTES", 4 * 4 * 40 * 5)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], 0, 1) for i in range(700)]
    rows += [(1000 + i, rows[100][1], 0, 1) for i in range(150)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), tree_rows=40, page=8, query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("size", [1.0, 1e3, 2e5])  # float32, float64 and whole products
def test_large_components(spark, size):
    rng = random.Random(10)
    rows = [(i, [size * rng.gauss(0, 1) for _ in range(5)], 0, 1) for i in range(500)]
    rows += [(1000 + i, [size * 3.0] * 5, 0, 1) for i in range(2)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), tree_rows=60, page=8, fanout=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_a_block_finds_what_single_queries_find():
    points = np.random.default_rng(11).integers(-40, 40, size=(900, 5))
    tree = K.MTree(np.arange(900), points, page=16, fanout=4)
    best = K.Best(np.arange(60), points[:60], np.full(60, K.NONE), 10)
    tree.search_all(best, np.arange(0, 60, 2))
    own, ids, scores = (x.tolist() for x in best.found())
    assert list(zip(own, ids, scores)) == [
        (q, i, s) for q in range(0, 60, 2) for i, s in zip(*(x.tolist() for x in tree.search(points[q], q, 10)))]
    value = points[:60:2] @ points.T
    for n, q in enumerate(range(0, 60, 2)):
        brute_ids = sorted((-s, i) for i, s in enumerate(value[n].tolist()) if i != q)[:10]
        assert [(-s, i) for o, i, s in zip(own, ids, scores) if o == q] == brute_ids
