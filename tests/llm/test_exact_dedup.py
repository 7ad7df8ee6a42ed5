from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_data import empty_docs, messy_docs, messy_rows, words
from tally.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append((r[0], r[1] or ""))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for i, (d, _) in enumerate(members):
            out.append((d, members[0][0], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [64, 1])
def test_messy_rows_equal_brute_force_even_when_digests_clash(spark, bits):
    got = X.exact_duplicates(messy_docs(spark), low=8, high=32, digest_bits=bits).drop("row_mark").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(messy_rows())


def test_chunks_join_to_the_text_and_cut_by_content(spark):
    text = words(random.Random(1), 3000).replace(" ", "")
    df = spark.createDataFrame([(text,), ("zz" + text,), ("",)], "t string")
    a, b, c = (r[0] for r in df.select(X.chunks(F.col("t"))).collect())
    assert "".join(a) == text and "".join(b) == "zz" + text and c == []
    assert all(len(x) <= X.MAX_CHUNK for x in a + b)
    assert len(set(a) & set(b)) >= len(a) // 2  # an insertion moves few cuts


def test_stage_keeps_all_columns_and_one_row_per_group(spark):
    docs = messy_docs(spark)
    kept = X.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    want = sorted((d for d, _, _, k, _ in brute(messy_rows()) if k), key=repr)
    assert got == want


def test_empty_table(spark):
    assert X.exact_duplicates(empty_docs(spark)).count() == 0
    assert X.keep_first(empty_docs(spark)).count() == 0
