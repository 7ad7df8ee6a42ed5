"""The registered corpus queries: contract columns, and equality with their SQL."""

from __future__ import annotations

import hashlib

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SMOKE_SF
from tally.llm import oracle, queries

COLUMNS = {
    "op1_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op4_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op8_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op10_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op11_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                          "toxic_lost", "shapley"],
    "op12_quality": ["doc_id", "held_out", "score", "predicted"],
    "op13_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}


def test_one_query_per_operator_is_registered():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(E.queries())
    assert set(oracle.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    result = compare(spark, SMOKE_SF, [name], verbose=False)[name]
    assert result[0] == "ok" and not result[3], result


@pytest.mark.parametrize("name", ["op1_secret_scan", "op5_toxicity", "op12_quality"])
def test_contract_columns_without_sql(spark, name):
    df = E.queries()[name](spark, SMOKE_SF)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    assert df.count() == spark.read.parquet(f"{SMOKE_SF}/documents.parquet").count()


def test_contract_columns_with_sql():
    import duckdb
    from compare import duck
    con: duckdb.DuckDBPyConnection = duck(SMOKE_SF)
    for name in set(COLUMNS) & set(oracle.oracle_sql()):
        assert con.sql(oracle.oracle_sql()[name]).columns[:len(COLUMNS[name])] == COLUMNS[name]


def test_planted_conversation_reads_back(spark):
    row = E.queries()["op4_chat_format"](spark, SMOKE_SF).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(said), sha(said))
    assert row["turns_sha256"] == sha(f"user\n{said}\nassistant\n{said}\n")
