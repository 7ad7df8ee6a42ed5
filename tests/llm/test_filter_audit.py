from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import pytest

from llm_data import DOCS, empty_docs, messy_docs, messy_rows, words
from tally.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int, part string, n int, failed string"
LABEL_ROWS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, 1, 1), (5, None, 1), (8, 1, None), (9, 1, 0), (14, 0, 1), (16, 1, 0),
              (None, 1, 1), (99, 1, 1)]


def label_rows():
    return [(*r, "clash", 5, "clash") for r in LABEL_ROWS]


def brute(rows, labels):
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    docs = []
    for d, text, lang, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        docs.append((lang or "", d in good, d in toxic, {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and any((o[1] or "") == t and o[0] is not None and o[0] < d for o in rows)}))
    out = Counter()
    shapley = Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part, g, x, f in docs:
            for step, c in enumerate(order, 1):
                before, here = any(f[e] for e in order[:step - 1]), f[c]
                key = (part, order, step)
                out[key, "kept"] += not before and not here
                out[key, "removed"] += here and not before
                out[key, "redundant"] += here and before
                out[key, "unique_fails"] += here and sum(f.values()) == 1
                out[key, "good_lost"] += here and not before and g
                out[key, "toxic_lost"] += here and not before and x
                shapley[part, c] += here and not before
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted((*key, *(out[key, n] for n in names), shapley[key[0], key[1][key[2] - 1]])
                  for key in {k for k, _ in out})


def rows():
    rng = random.Random(2)
    more = [(100 + i, words(rng, 250) + rng.choice(["", " #", " A B C D", " | x"]) * 20, "de", None, 1, 1, True, 1, "x", "x")
            for i in range(12)]
    more += [(200 + i, "same words again " * 90, None, None, 1, 1, True, 1, "x", "x") for i in range(5)]
    more += [(300, "ÄÖÜ 日本 A" * 2, "", None, 1, 1, True, 1, "x", "x"), (301, "𝔸BC", "ja", None, 1, 1, True, 1, "x", "x")]
    return messy_rows() + more


@pytest.mark.parametrize("shard_bytes", [1, 4000, A.SHARD_BYTES])
def test_messy_rows_equal_brute_force(spark, shard_bytes):
    docs = spark.createDataFrame(rows(), DOCS).repartition(4)
    got = A.audit(docs, spark.createDataFrame(label_rows(), LABELS), shard_bytes)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute(rows(), LABEL_ROWS)


@pytest.mark.parametrize("code_bits", [A.CODE_BITS, 5])
def test_matrix_holds_every_word_under_one_code_even_when_hashes_clash(spark, code_bits):
    texts = [(i, "the " * (i % 3 + 1) + words(random.Random(i % 7), 40), None) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").repartition(6)
    m = A.TermMatrix(docs, shard_bytes=500, code_bits=code_bits)
    rows = m.dictionary.collect()
    names = {r["code"]: r["word"] for r in rows}
    assert len(names) == len(rows) and {r["word"] for r in rows} == {w for _, t, _ in texts for w in t.split()}
    assert any(c < 0 for c in names) == (code_bits == 5)
    got = {}
    for s in m.shards.collect():
        for i, d in enumerate(s["doc_ids"]):
            cols, counts = (s[n][s["bounds"][i]:s["bounds"][i + 1]] for n in ("cols", "counts"))
            assert cols == sorted(cols)
            got[d] = {names[c]: n for c, n in zip(cols, counts)}
    assert got == {d: Counter(t.split()) for d, t, _ in texts}
    assert {(r["doc_id"], r["n_words"], r["n_distinct"]) for r in m.documents().collect()} == {
        (d, len(t.split()), len(set(t.split()))) for d, t, _ in texts}


def test_empty_tables(spark):
    no_labels = spark.createDataFrame([], LABELS)
    assert A.audit(empty_docs(spark), no_labels).collect() == []
    got = A.audit(messy_docs(spark), no_labels)
    assert sorted(map(tuple, got.collect())) == brute(messy_rows(), [])


def test_no_shard_is_written_or_given_to_spark_as_a_row(spark, monkeypatch):
    written = {}
    whole = A.materialise

    def noted(df, label):
        written[label] = df.columns
        assert "parquet" not in df._jdf.queryExecution().optimizedPlan().toString().lower()  # nothing read back
        return whole(df, label)

    monkeypatch.setattr(A, "materialise", noted)
    docs = spark.createDataFrame(rows(), DOCS).repartition(4)
    got = A.audit(docs, spark.createDataFrame(label_rows(), LABELS))
    assert sorted(map(tuple, got.collect())) == brute(rows(), LABEL_ROWS)
    assert written == {"term-rows": ["doc_id", "part", "digest", "n_words", "n_distinct", "n_chars", "n_capitals", "n_special"]}


def test_codes_in_shards_are_the_dictionarys(spark):
    texts = [(1, "a ab\tabc\x0bä 日本語 𝔸\x0c " + "long" * 30 + " \x1c\x85\xa0 a", None), (2, "\n  \r", None), (3, None, None)]
    m = A.TermMatrix(spark.createDataFrame(texts, "doc_id bigint, text string, lang string"))
    names = {r["code"]: r["word"] for r in m.dictionary.collect()}
    got = {d: {names[c]: n for c, n in zip(s["cols"][a:b], s["counts"][a:b])}
           for s in m.shards.collect() for d, a, b in zip(s["doc_ids"], s["bounds"], s["bounds"][1:])}
    assert got == {d: Counter(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in texts}
