from __future__ import annotations

import corpus_pipeline as C
from llm_data import messy_docs, messy_rows, words


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    import random
    rng = random.Random(3)
    rows = list(messy_rows())
    labels = []
    for i in range(300):
        bad = i % 4 == 0
        text = words(rng, 40) + (" vileking vileton grumbleheap" if bad else "")
        rows.append((100 + i, text, "en", f"s{i % 4}", len(text), 7, True, -1, "clash", "clash"))
        labels.append((100 + i, 1, int(bad)))
    docs = spark.createDataFrame(rows, messy_docs(spark).schema)
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    counts, now = [], docs
    for name, stage in C.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(now.count())
    toxic, exact, near, mixed, pieces = counts
    clean = {r[0] for r in rows if not (r[0] or 0) >= 100 or (r[0] - 100) % 4}
    left = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/toxicity").collect()}
    assert len(clean - left) <= 3 and len(left - clean) <= 3
    assert exact == toxic - 8 or exact < toxic  # copies, empty texts and repeated rows go
    assert near < exact and mixed > near and pieces == mixed


def test_run_over_the_smallest_tables(spark):
    out = C.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_pieces", "ids", "decoded"] and out.count() > 100
