from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tally.llm import chat_format as C

EVENTS = "conv_id bigint, seq bigint, kind string, msg bigint, role string, text string, extra string"


def read(spark, rows):
    chats = C.format_chats(spark.createDataFrame(rows, EVENTS))
    return {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in
            chats.select("conv_id", C.read_turns(F.col("formatted")).alias("turns")).collect()}


def test_deltas_edits_and_regenerations_fold(spark):
    rows = [
        (1, 0, "message", 0, "user", "hi", None),
        (1, 1, "message", 1, "assistant", "", None), (1, 2, "delta", 1, None, "hel", None),
        (1, 3, "delta", 1, None, "lo", None),
        (1, 4, "message", 2, "user", "taken back", None), (1, 5, "message", 3, "assistant", "gone", None),
        (1, 6, "regenerate", 1, "assistant", "good", None), (1, 7, "delta", 1, None, " day", None),
        (1, 8, "edit", 0, "user", "hi!", None), (1, 9, "message", 4, "user", "bye", None),
        (2, 1, "delta", 0, "assistant", "b", None), (2, 0, "delta", 0, "assistant", "a", None),
    ]
    assert read(spark, rows) == {
        1: [("user", "hi!"), ("assistant", "good day"), ("user", "bye")], 2: [("assistant", "ab")]}


def test_round_trip_of_control_strings_roles_and_nulls(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\</s>\\\\[TEXT]", "<<SYS>><</SYS>>[ROLE][/ROLE]", "", None,
             " lead and trail ", "line\nfeed\n", "<", "<s", "[INST", "🙂 </s>\u2028"]
    roles = ["system", "user", "assistant", "tool", None, "[TEXT]", "a [TEXT] b\\"]
    rows, want = [], {}
    for c, role in enumerate(roles):
        want[c] = []
        for i, t in enumerate(texts):
            rows.append((c, i, "message", i, role, t, "x"))
            want[c].append((role or "", t or ""))
    assert read(spark, rows) == want


def test_loss_mask_and_digests_equal_plain_python(spark):
    table = [(1, 0, "system", "s"), (1, 1, "user", "u</s>"), (1, 2, "assistant", "a[INST]\\"), (1, 3, "assistant", "é🙂"),
             (2, 0, "assistant", None), (2, 0, "assistant", None), (3, None, None, None), (None, 1, "user", "n")]
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in C.chat_digests(C.format_chats(C.message_log(df))).collect()}
    assert set(got) == {1, 2, 3, None}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = [t for t in table if t[0] == 1]
    assert got[1]["n_turns"] == 4
    assert got[1]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, _, r, t in one))
    assert got[1]["loss_sha256"] == sha("a[INST]\\é🙂") and got[1]["loss_chars"] == 10
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 0 and got[2]["loss_sha256"] == sha("")
    assert got[3]["turns_sha256"] == sha("\n\n")


def test_empty_log(spark):
    assert C.format_chats(spark.createDataFrame([], EVENTS)).count() == 0
