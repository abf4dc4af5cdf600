"""Chat formatting: the examples, the way back, and the SQL."""

import hashlib

import pytest
from compare import connect, duck_rows, spark_rows

from plantroom.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, pieces int"


def examples(spark, rows):
    found = chat.expand_replies(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (str(r[0]), r[1])), found


def test_every_reply_is_an_example_of_its_own(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u<|"), (1, 2, "assistant", "a\\"), (1, 3, "user", "v"), (1, 4, "assistant", "b"), (1, 5, "user", "w")]
    found, _ = examples(spark, rows)
    head = "<|system|>s<|end|><|user|>u<\\|<|end|><|assistant|>"
    first = head + "a\\\\<|end|>"
    second = first + "<|user|>v<|end|><|assistant|>b<|end|>"
    assert [r[3] for r in found] == [first, second, second + "<|user|>w<|end|>"]
    assert [r[2] for r in found] == [False, False, True]
    assert [r[3][r[4] : r[5]] if r[4] is not None else None for r in found] == ["a\\\\", "b", None]


TRICKY = ["", None, "\\### Assistant: </turn> ok", "<|end|>", "<|user|>x<|end|>", "\\", "\\\\|", "<", "<|", "<\\|", "|>", "é\n\t<|\\", "x" * 200_000, "<" * 999]


@pytest.mark.parametrize("role", ["assistant", "user", "a|>b", "\\", "|", "", None])
def test_round_trip(spark, role):
    turns = [(7, i, role, t) for i, t in enumerate(TRICKY)] + [(7, 99, "assistant", "<|end|>")]
    _, found = examples(spark, turns)
    last = found.where("is_last").select(chat.read_turns(found["text"]).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in last] == [(role or "", t or "") for _, _, _, t in turns[:-1]] + [("assistant", "<|end|>")]


def test_order_ties_repeats_and_nulls(spark):
    rows = [(None, 1, "assistant", "n"), (None, 0, "user", "m"), (2, None, "user", "first"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "assistant", "z")]
    result = {r["conv_id"]: r for r in chat.digests(examples(spark, rows)[1]).collect()}
    sha = lambda turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert result[2]["turns_sha256"] == sha([("user", "first"), ("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")])
    assert result[2]["n_turns"] == 5 and result[2]["loss_chars"] == 1
    assert result[None]["turns_sha256"] == sha([("user", "m"), ("assistant", "n")])
    assert chat.expand_replies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_sql(spark):
    found = queries.op4_prefix_target_expansion(spark, "/root/testdata/sf0.01")
    con = connect("/root/testdata/sf0.01")
    assert spark_rows(found) == duck_rows(con, queries.ORACLES["op4_prefix_target_expansion"])
    assert found.where("conv_id = -7").first()["loss_sha256"] == hashlib.sha256(queries.MARKED.encode()).hexdigest()
