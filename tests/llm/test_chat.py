from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tidewatch.llm import chat

TURN = "conv_id long, turn long, role string, text string"
T = chat.Template()
texts = st.one_of(st.text(max_size=30), st.lists(st.sampled_from([*chat.CONTROL_STRINGS, "\\", "<", "|", "\n", "a", "[INS", "T]"]), max_size=6).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), texts), texts), max_size=4))
def test_formatted_turns_are_read_back_unchanged(turns):
    formatted = "".join(piece for role, text in turns for piece, _ in T.segments(role, text))
    assert T.parse(formatted) == turns
    for _, text in turns:
        assert not any(c in T.escape(text) for c in chat.CONTROL_STRINGS)


def rows_of(spark, rows):
    return {r["conv_id"]: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, TURN))).collect()}


def test_digests_loss_and_order(spark):
    got = rows_of(spark, [(1, 2, "user", "c"), (1, 0, "user", "</s>"), (1, 1, "assistant", "b\\"), (2, 0, "assistant", "x"), (3, 0, "system", "s"), (3, 1, "user", None)])
    assert got[1]["n_turns"] == 3 and got[1]["valid"] and got[1]["loss_chars"] == 2
    assert got[1]["turns_sha256"] == hashlib.sha256("user\n</s>\nassistant\nb\\\nuser\nc\n".encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"b\\").hexdigest()
    assert not got[2]["valid"] and got[3]["valid"] and got[3]["loss_sha256"] == hashlib.sha256(b"").hexdigest()


def test_machine_marks_what_is_out_of_order(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "tool", "x"), (None, None, None, None)]
    segments = chat.format_chat(spark.createDataFrame(rows, TURN)).collect()
    problems = {(r["conv_id"], r["seq"]): r["problem"] for r in segments if r["problem"]}
    assert problems == {(1, 3): "role", (2, 3): "turn", (3, 0): "role", (None, 0): "role"}
    got = rows_of(spark, rows)
    assert set(got) == {1, 2, 3, None} and got[None]["n_turns"] == 1


def test_long_conversation_crosses_batches_and_empty_table(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", "t" * (i % 9)) for i in range(200)]
    got = rows_of(spark, rows)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[5]["n_turns"] == 200 and got[5]["valid"]
    assert chat.read_back(chat.format_chat(spark.createDataFrame([], TURN))).count() == 0


def test_templates_that_cannot_be_read_back_are_refused():
    with pytest.raises(ValueError):
        chat.Template(head="{role}: ")
