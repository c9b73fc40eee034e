"""Records that no layout foresaw do not end the job, and ids that do not fit are refused."""

import json

import pytest

from platewise.llm import binary, chat
from platewise.llm.queries import vocabulary


def test_odd_records(spark):
    deep = '{"messages": ' + "[" * 100_000 + "]" * 100_000 + "}"
    rows = [
        (1, '{"turn": 0, "role": "user", "text": "a\\ud800b"}'), (1, '{"turn": 1, "role": 5, "text": "\\udfff"}'), (1, '{"turn": "later", "role": null, "text": 7}'),
        (2, deep), (2, "no json"), (3, '{"unknown": 1}'), (4, None), (5, json.dumps({"messages": [{"role": True, "content": None}, {"role": "gpt", "content": 1.5}]})),
        (None, '{"prompt": "p", "response": 5}'), (6, f'{{"turn": {10**30}, "role": "user", "text": ""}}'),
    ]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string"))
    formatted = chat.format_turns(turns)
    back = formatted.select("conv_id", "formatted", chat.read_back(formatted["formatted"], formatted["mask"]).alias("b")).collect()
    got = {r["conv_id"]: ([(t["role"], t["text"]) for t in r["b"]["turns"]], list(r["b"]["learned"])) for r in back}
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    assert got[1][0] == [("user", "a�b"), ("5", "�"), ("", "7")]
    assert got[2] == got[3] == got[4] == ([], [])
    assert got[5] == ([("true", ""), ("assistant", "1.5")], ["1.5"])
    assert got[None] == ([("user", "p"), ("assistant", "5")], ["5"]) and got[6][0] == [("user", "")]


def test_empty_table(spark):
    turns = chat.canonical_turns(spark.createDataFrame([], "conv_id long, record string"))
    assert chat.format_turns(turns).collect() == []


def test_ids_that_do_not_fit(spark):
    docs = spark.createDataFrame([(1, "some words that have ids above a byte")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit"):
        binary.pack_shards(docs, vocabulary(), dtype="<u1").collect()
