from __future__ import annotations

from collections import Counter, defaultdict

from llm_data import empty_docs, messy_docs
from tally.llm import source_mix as M


def fill(sizes: dict, weights=(5, 2, 1)):
    """Targets by repeated clamping and resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = budget - sum(2 * sizes[s] for s in full)
        total = sum(w[s] for s in order if s not in full)
        over = {s for s in order if s not in full and w[s] * free / total > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2 * sizes[s] if s in full else w[s] * free / total for s in order}
        full |= over


def test_targets_and_taken_words(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{(i * i) % 7}" if i % 9 else None) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = M.mix(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in M.mix(docs.repartition(7)).collect()}
    sizes, taken, target = Counter(), Counter(), {}
    source = {r[0]: r[2] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        assert again[r["doc_id"]] == r["taken"]
    want = fill(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= 20  # half a document


def test_small_documents_behind_a_long_one_fill_the_target(spark):
    """One very long document cannot hold up the rest: each source ends within half
    of its smallest document that still fits, or 0.5 %, of its target."""
    rows = [(i, "w " * (20_000 if i % 500 == 3 else 100 + i % 7), f"s{i % 3}") for i in range(3000)]
    got = M.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)).collect()
    taken, target = Counter(), {}
    for r in got:
        s = f"s{r['doc_id'] % 3}"
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= max(0.005 * target[s], 53), (s, taken[s], target[s])


def test_sources_of_the_given_table_come_near_their_targets(spark):
    """Within 0.5 % of the target, or half the smallest document that was not taken once more."""
    from conftest import CHECK_SF
    docs = spark.read.parquet(f"{CHECK_SF}/documents.parquet")
    taken, target, sizes = Counter(), {}, defaultdict(list)
    for r in M.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        sizes[r["source"]].append((r["repeats"], r["size"]))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(0.005 * t, min(sizes[s])[1] / 2), s


def test_sample_repeats_rows_as_the_mix_says(spark):
    docs = messy_docs(spark)
    want = defaultdict(int)
    for r in M.mix(docs).collect():
        want[r["doc_id"]] += r["repeats"]
    out = M.sample(docs)
    assert out.columns == docs.columns
    got = Counter(r["doc_id"] for r in out.collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_one_source_without_words_and_empty_table(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", "a")], "doc_id bigint, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in M.mix(docs).collect()] == [(0, 0.0, 0)] * 2
    assert M.mix(empty_docs(spark)).count() == 0
    assert M.sample(empty_docs(spark)).count() == 0
