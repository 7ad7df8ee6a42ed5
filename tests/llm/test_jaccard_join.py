from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

from llm_data import empty_docs, messy_docs, messy_rows, words
from tally.llm import jaccard_join as J


def brute(rows, shingle=5, threshold=Fraction(4, 5)):
    """{row index: (class id, links)} over all pairs."""
    sets, n = [], len(rows)
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    linked = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and Fraction(both, len(sets[i] | sets[j])) >= threshold:
                linked[i].append(j)
                linked[j].append(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        stack, members = [i], {i}
        while stack:
            for j in linked[stack.pop()]:
                if j not in members:
                    members.add(j)
                    stack.append(j)
        seen |= members
        head = min((rows[m][0] for m in members if rows[m][0] is not None), default=None)
        for m in members:
            out[m] = (rows[m][0], head, len(linked[m]))
    return sorted(out, key=repr)


def near_rows():
    rng = random.Random(9)
    rows, base = [], words(rng, 150).split()
    for i in range(120):                                   # one large group of near copies, chained
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    for g in range(25):
        w = words(rng, rng.randint(5, 60)).split()
        for c in range(3):
            v = list(w)
            if c:
                v[rng.randrange(len(v))] = f"y{c}"
            rows.append((1000 + 10 * g + c, "  ".join(v)))
    return rows + [(5000, words(rng, 30)), (5001, None), (5002, ""), (5003, "a b"), (5004, "a  b"), (5000, "a b c d")]


@pytest.mark.parametrize("shape", [dict(block=16), dict(), dict(block_words=500)])
def test_classes_and_links_equal_brute_force(spark, shape):
    rows = near_rows()
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), **shape)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=repr) == brute(rows)


def test_messy_rows_and_stage(spark):
    rows = [(r[0], r[1]) for r in messy_rows()]
    docs = messy_docs(spark)
    got = J.near_duplicates(docs)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=repr) == brute(rows)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and not {2, 3, 4} & set(ids) and 8 in ids and 9 not in ids
    assert ids.count(5) == 1 and ids.count(None) == 1  # repeated and empty texts
    assert J.near_duplicates(empty_docs(spark)).count() == 0
    assert J.keep_one(empty_docs(spark)).count() == 0


def test_prefix_is_shortened_until_the_recall_is_reached():
    d = J.depth_for(0.8, J.TREES, J.MAX_DEPTH, J.RECALL)
    recall = lambda k: 1 - (1 - 0.8 ** k) ** J.TREES
    assert recall(d) >= J.RECALL > recall(d + 1)


def test_components_of_long_chains(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z2", "z1"), ("z2", "z3")]
    got = {r["node"]: r["root"] for r in J.components(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert {v for k, v in got.items() if k.startswith("n")} == {"n000"} and len(got) == 62
    assert got["z3"] == got["z2"] == "z1"


def test_shingle_length_and_threshold_are_parameters(spark):
    rows = near_rows()
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), Fraction(1, 2), trees=60, shingle=2)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=repr) == brute(
        rows, 2, Fraction(1, 2))


def _copies(spark, rows, block):
    """Rows that the blocks write, per text."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = J.sketch(docs).select("_key", "_words", "_labels").dropDuplicates(["_key"])
    out = J.text_blocks(texts, block).selectExpr("_key", "size(_blocks) n", "_blocks[0]._tree tree").collect()
    return {r["_key"]: (r["n"], r["tree"]) for r in out}


def test_texts_of_a_hot_group_are_sent_once_per_part(spark):
    rng = random.Random(3)
    base = words(rng, 200).split()
    rows = []
    for i in range(900):
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = f"v{i}"
        rows.append((i, " ".join(w)))
    J.ship_package(spark)
    for n in (300, 900):
        got = _copies(spark, rows[:n], 100)
        assert len(got) >= 0.99 * n
        assert sum(c for c, _ in got.values()) <= len(got) * (n // 100 + 1)
        assert {t for _, t in got.values()} == {J.WHOLE}


def test_long_chains_are_compared_bucket_by_bucket(spark):
    rng = random.Random(4)
    w, rows = words(rng, 300).split(), []
    for i in range(150):                              # each text drops words in front and gets as many behind
        rows.append((i, " ".join(w)))
        w = w[12:] + words(rng, 12).split()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    J.ship_package(spark)
    assert any(t != J.WHOLE for _, t in _copies(spark, rows, J.BLOCK).values())
    got = J.near_duplicates(docs)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links").collect()), key=repr) == brute(rows)


def test_intersections_of_two_sides():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, size=k, dtype=np.uint64)) for k in (1, 5, 30, 60, 9, 17)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = J.intersections(sets, columns=7)            # a set's own size is not asked for
    assert [[c for j, c in enumerate(r) if j != i] for i, r in enumerate(got.tolist())] == [
        [c for j, c in enumerate(r) if j != i] for i, r in enumerate(want)]
    assert J.intersections(sets[:2], sets[2:], columns=7).tolist() == [r[2:] for r in want[:2]]
