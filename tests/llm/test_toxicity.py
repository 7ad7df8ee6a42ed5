from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from llm_data import empty_docs, messy_docs, words
from tally.llm import toxicity as T


def corpus():
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(900):
        w = words(rng, rng.randint(5, 80)).split()
        bad = rng.random() < 0.25
        if bad:
            for _ in range(max(1, len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(["grumbleheap", "vileking", "vileton", "vilesome"])
        docs.append((i, " ".join(w)))
        if rng.random() < 0.7:
            labels.append((i, None, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs + [(5000, None), (5001, ""), (None, "vileroy vilesome vileton")], "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    return docs, T.score_toxicity(d, lab).collect()


def test_held_out_accuracy_and_unseen_endings(scored):
    docs, rows = scored
    bad = {i for i, t in docs if "vile" in t or "grumble" in t}
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 5000]
    right = sum((r["doc_id"] in bad) == bool(r["predicted"]) for r in held)
    assert right / len(held) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5000]["score"] == by_id[5001]["score"] < 0.5
    assert by_id[None]["predicted"] == 1


def test_tables_are_log_ratios_of_normalised_models():
    rng = random.Random(1)
    import pandas as pd
    from collections import Counter
    counts = [Counter(), Counter()]
    for c in (0, 1):
        for _ in range(400):
            m = T.marked("".join(rng.choice("abc" if c else "abd") for _ in range(rng.randint(1, 6))))
            for k in range(len(m) - T.ORDER + 1):
                counts[c][m[k:k + T.ORDER]] += 1
    level = pd.DataFrame([(g, counts[1][g], counts[0][g], 1) for g in set(counts[0]) | set(counts[1])],
                         columns=["gram", "toxic", "plain", "any"])
    grams, contexts, shared = {}, {}, {}
    less = lambda s: (s - T.DISCOUNT).clip(lower=0)
    for n in range(T.ORDER, 0, -1):
        if n > T.SHARED:
            grams[n] = level[["gram", "toxic", "plain"]]
            contexts[n] = level.assign(context=level.gram.str[:-1], kt=less(level.toxic), ko=less(level.plain)).groupby(
                "context").agg(t=("toxic", "sum"), o=("plain", "sum"), kt=("kt", "sum"), ko=("ko", "sum")).reset_index()
        else:
            shared[n] = level[["gram", "any"]]
        level = level.assign(gram=level.gram.str[1:], toxic=(level.toxic > 0) * 1, plain=(level.plain > 0) * 1, any=1).groupby(
            "gram").sum().reset_index()
    ratios, backoff = T._tables(grams, contexts, shared)
    p = T._shared_model(shared)
    letters = [g for g in shared[1]["gram"]]
    for context in ("\x02\x02", "ab", "b"):
        assert sum(p((context + x)[-3:]) for x in letters) <= 1 + 1e-9
    model = T.Ratios(ratios, backoff)
    assert model.word("dddd") < -1 < 1 < model.word("cccc")
    assert abs(model.word("abab")) < 1.5


def test_logistic_fit_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] > 0.2).astype(float)
    w = T.fit_logistic(x, y)
    assert (((x @ w[:-1] + w[-1]) > 0) == (y > 0)).mean() > 0.97


def test_missing_classes_messy_rows_and_stage(spark):
    docs = messy_docs(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["score"] for r in T.score_toxicity(docs, none).collect()] == [0.0] * docs.count()
    plain = spark.createDataFrame([(i, 1, 0) for i in range(1, 18)], "doc_id bigint, quality int, toxic int")
    kept = T.drop_toxic(docs, plain)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert T.score_toxicity(empty_docs(spark), plain).count() == 0


def test_model_keeps_every_gram_of_a_large_vocabulary(spark):
    """More n-grams of each order than any fixed bound of 65,536, most seen once."""
    from collections import Counter
    import pandas as pd
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = [" ".join("".join(rng.choice(letters) for _ in range(7)) for _ in range(100)) for _ in range(300)]
    rows = spark.createDataFrame([(t, int(i % 10 == 0)) for i, t in enumerate(text)], "_text string, _toxic int")
    T.ship_package(spark)
    table = T.train(rows)
    counts = [Counter(), Counter()]
    for i, t in enumerate(text):
        for w in t.split():
            m = T.marked(w)
            counts[i % 10 == 0].update(m[k:k + T.ORDER] for k in range(len(w) + 1))
    level = pd.DataFrame([(g, counts[1][g], counts[0][g], 1) for g in set(counts[0]) | set(counts[1])],
                         columns=["gram", "toxic", "plain", "any"])
    grams, contexts, shared = {}, {}, {}
    for n in range(T.ORDER, 0, -1):
        if n > T.SHARED:
            grams[n] = level[["gram", "toxic", "plain"]]
            less = level[["toxic", "plain"]].sub(T.DISCOUNT).clip(lower=0)
            contexts[n] = level.assign(context=level.gram.str[:-1], kt=less.toxic, ko=less.plain).groupby("context").agg(
                t=("toxic", "sum"), o=("plain", "sum"), kt=("kt", "sum"), ko=("ko", "sum")).reset_index()
        else:
            shared[n] = level[["gram", "any"]]
        level = level.assign(gram=level.gram.str[1:], toxic=(level.toxic > 0) * 1, plain=(level.plain > 0) * 1, any=1).groupby(
            "gram").sum().reset_index()
    assert len(grams[T.ORDER]) > 1 << 16
    whole = T.Ratios(*T._tables(grams, contexts, shared))
    words_in = sorted({w for t in text[:20] for w in t.split()}) + ["neverseen", "zz", "é", "qz" * 4000]
    want = [whole.word(w) for w in words_in]
    docs = spark.createDataFrame(list(enumerate(words_in)), "doc_id bigint, text string")
    for mapped_rows in (0, T.MAPPED_ROWS):
        got = {words_in[r["doc_id"]]: r["x0"] * (len(words_in[r["doc_id"]]) + 1)
               for r in T.text_figures(docs, table, mapped_rows).collect()}
        assert np.allclose([got[w] for w in words_in], want)
        assert min(got[w] for w in text[0].split()) > 1  # toxic words seen once keep their class evidence


def test_figures_of_both_ways_equal_those_of_texts(spark):
    """Rows of several shards, repeated, empty and very long ones, and words of any length."""
    rng = random.Random(5)
    T.ship_package(spark)
    train = spark.createDataFrame([(words(rng, 40), i % 2) for i in range(60)], "_text string, _toxic int")
    table = T.train(train)
    grams = {r["key"]: r["value"] for r in table.collect()}
    model = T.Ratios({k: v for k, v in grams.items() if not k.endswith(T._BACKOFF)},
                     {k[:-1]: v for k, v in grams.items() if k.endswith(T._BACKOFF)})
    texts = [words(rng, n) for n in (1, 2, 3, 49, 50, 51, 400, 3000)] + ["", None, " . ", "q" * 5000, "É é x" * 30]
    texts += [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(100_000))]  # more than 65,536 words
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, "other text"), (None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts, mapped_rows, shard_text in ((1, 0, T.SHARD_TEXT), (4, 0, 20_000), (4, T.MAPPED_ROWS, T.SHARD_TEXT)):
        got = T.text_figures(docs.repartition(parts), table, mapped_rows, shard_text).collect()
        assert len(got) == len(rows)
        want = []
        for i, t in rows:
            w = T.words_of(t or "")
            ratio = {x: model.word(x) for x in set(w)}
            want.append((i, T.figures(np.array([ratio[x] for x in w]), np.array([len(x) + 1.0 for x in w]))
                         if w else (None,) * 4))
        order = lambda r: (r[0] is None, r[0] or 0, r[1][0] or 0)
        for (i, x), (j, y) in zip(sorted(want, key=order), sorted(
                ((r["doc_id"], tuple(r[k] for k in T._FIGURES)) for r in got), key=order)):
            assert i == j and (x == y if x[0] is None else np.allclose(x, y))


def test_drop_toxic_keeps_columns_of_any_name(spark):
    docs, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = [(i, t, i, "m", None) for i, t in docs] + [(docs[0][0], docs[0][1], 0, "m", None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, _t_id int, _T_MARK string, _t_row string")
    kept = T.drop_toxic(d, lab)
    assert kept.columns == d.columns
    bad = {i for i, t in docs if "vile" in t or "grumble" in t}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(set(ids) ^ (set(range(900)) - bad)) < 30
    assert ids.count(0) in (0, 2)  # repeated rows stay or go together
