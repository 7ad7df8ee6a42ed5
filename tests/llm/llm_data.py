"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "size bigint, kept boolean, class_id bigint, row_mark string, target string")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeioustnrl") for _ in range(rng.randint(2, 8))) for _ in range(n))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    base = words(rng, 120)
    changed = base.split()
    changed[60] = "other"
    long = words(rng, 60_000)
    texts = [
        (1, base), (2, base), (2, base), (3, "  " + base.replace(" ", "\n") + " "), (4, " ".join(changed)),
        (5, None), (6, ""), (7, " \t\n "), (8, long), (9, long + " end"), (10, "one two"), (11, "two one"),
        (12, "one  two"), (None, base), (None, None), (13, "naïve 日本語 🙂 ʻtextʼ \x0b x"), (14, "x" * 70_000),
        (15, "</s>[INST] ok [/INST]"), (16, words(rng, 400)), (17, words(rng, 7)), (5, None),
    ]
    rows = []
    for i, (d, t) in enumerate(texts):
        rows.append((d, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}",
                     None if t is None else len(t), 7, True, -1, "clash", "clash"))
    return rows


def messy_docs(spark):
    return spark.createDataFrame(messy_rows(), DOCS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
