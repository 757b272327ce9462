import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millwright.llm import chat_format

HARD = ["", "plain", "\\", "\\\\l", "<turn user>\n", "</turn>\n", "\\b\\l\\g<>", "a\nb\n", "é\U0001f600<", ">\n", "\r\n \t"]


def turn_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, block string")


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_round_trip(spark):
    rows = [(n, i, role, text, "x") for n, text in enumerate(HARD) for i, role in enumerate(("user", "assistant", "<a>\\"))]
    chats = chat_format.read_back(chat_format.formatted(chat_format.turns_of_table(turn_rows(spark, rows))))
    for chat in chats.collect():
        text = HARD[chat.conv_id]
        assert [(t.role, t.text) for t in chat.turns] == [("user", text), ("assistant", text), ("<a>\\", text)]
        assert chat.loss_texts == [text]
        assert chat.formatted.count("<turn ") == 3 == chat.formatted.count("</turn>")


def test_report(spark):
    rows = [
        (1, 2, "assistant", "c", ""), (1, 0, "system", None, ""), (1, 1, "user", "b", ""), (1, 3, "assistant", "é<", ""),
        (None, 0, None, "x", ""), (2, None, "user", "z", ""), (2, 0, "user", "y", ""), (2, 0, "user", "y", ""),
    ]
    got = {r.conv_id: r for r in chat_format.report(chat_format.turns_of_table(turn_rows(spark, rows))).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (4, 3)
    assert got[1].turns_sha256 == digest([("system", ""), ("user", "b"), ("assistant", "c"), ("assistant", "é<")])
    assert got[1].loss_sha256 == hashlib.sha256("cé<".encode()).hexdigest()
    assert got[None].turns_sha256 == digest([("", "x")])
    assert got[2].turns_sha256 == digest([("user", "z"), ("user", "y"), ("user", "y")])
    assert chat_format.report(chat_format.turns_of_table(turn_rows(spark, []))).count() == 0


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": 1}, "messages"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "exchange"),
    ({"instruction": "q", "output": "a"}, "instruction"),
    ({"instruction": "q", "input": None, "output": "a", "id": "z"}, "instruction"),
    ({"instruction": "q", "input": "more", "output": "a"}, "instruction_input"),
    ({"prompt": "q", "completion": "a"}, "prompt_completion"),
    ({"prompt": "q", "response": "a"}, "prompt_response"),
    ({"question": "q", "answer": "a"}, "question_answer"),
    ({"something": "else"}, None),
]


def test_records_of_mixed_layouts(spark):
    rows = [(json.dumps({"conv_id": n, **record}),) for n, (record, _) in enumerate(RECORDS)]
    turns = chat_format.turns_of_json(spark.createDataFrame(rows, "record string"), "record").collect()
    for n, (_, layout) in enumerate(RECORDS):
        own = sorted((t.turn, t.role, t.text) for t in turns if t.conv_id == n and t.turn is not None)
        question = "q\nmore" if layout == "instruction_input" else "q"
        assert {t.layout for t in turns if t.conv_id == n} == {layout}
        assert own == ([(0, "user", question), (1, "assistant", "a")] if layout else [])


def test_tables_are_recognised_by_their_schema(spark):
    nested = spark.createDataFrame(
        [(1, [("human", "q"), ("gpt", "a")], 5)], "conv_id long, conversations array<struct<`from`:string,value:string>>, n int"
    )
    assert chat_format.layout_of(nested.schema).name == "exchange"
    assert [(t.role, t.text) for t in chat_format.turns_of_table(nested).orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat_format.turns_of_table(spark.range(1).select(F.col("id").alias("conv_id"), F.lit("x").alias("body")))


def test_fingerprints_differ():
    prints = [layout.fingerprint for layout in chat_format.LAYOUTS]
    assert len(set(prints)) == len(prints)
    assert chat_format.fingerprint(["b", "a"]) == chat_format.fingerprint(("a", "b", "a"))
