"""Helpers that take the user's whole rows: extra columns may have any name."""

from __future__ import annotations

import pytest

from llm_data import words
from tally.llm import common, exact_dedup, jaccard_join, source_mix

OWN = ["_t_row", "_t_id", "_t_mark", "_T_Kept", "_t_rows", "_t_key", "_t_digest", "_t_source", "_t_plan", "_t_n", "_t_i", "a.b"]


def rows(spark):
    import random
    rng = random.Random(4)
    texts = [words(rng, 30) for _ in range(12)]
    texts += [texts[0], texts[0], "  " + texts[1], texts[2] + " end", "", None]
    data = [(i, t, "en", f"s{i % 3}", 1, *[f"{n}{i}" for n in OWN]) for i, t in enumerate(texts)]
    data.append(data[0])
    schema = "doc_id bigint, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in OWN)
    return spark.createDataFrame(data, schema), data


@pytest.mark.parametrize("stage", [exact_dedup.keep_first, jaccard_join.keep_one, source_mix.sample])
def test_stages_keep_the_values_of_columns_with_their_own_names(spark, stage):
    docs, data = rows(spark)
    out = stage(docs)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert got and set(got) <= set(data)


def test_free_names_are_free_in_any_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "X int, x_ int, y int")
    assert common.free_names(df, "x", "z", "Y") == ["x__", "z", "Y_"]
