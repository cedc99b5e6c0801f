"""Layouts of records and tables: none is lost, none is taken for another."""

import pytest

from marketlake.llm import chat

RECORDS = {
    # One known field too many; elements with fields missing; lists and objects in the place of texts; nulls.
    1: ('{"instruction": "i", "output": "o", "prompt": "p"}', [("user", "i"), ("assistant", "o")], ["prompt"]),
    2: ('{"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}, {"content": "c"}]}', [("user", ""), ("assistant", "a"), ("", "c")], []),
    3: ('{"prompt": [{"role": "user", "content": "q"}], "response": "r"}', [("user", "q"), ("assistant", "r")], []),
    4: ('{"prompt": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}], "completion": [{"role": "assistant", "content": "a"}]}', [("system", "s"), ("user", "q"), ("assistant", "a")], []),
    5: ('{"prompt": [{"role": "user", "content": "q"}]}', [("user", "q")], []),
    6: ('{"prompt": "p", "response": "r", "completion": "c"}', [("user", "p"), ("assistant", "r")], ["completion"]),
    7: ('{"question": null, "answer": 42}', [("user", ""), ("assistant", "42")], []),
    8: ('{"conversations": [{"from": "human", "value": "h"}], "question": "x"}', [("human", "h")], ["question"]),
    9: ('{"prompt": [{"role": "user", "content": "q"}], "completion": "c"}', [("user", "q"), ("assistant", "c")], []),
    # No layout.
    10: ('{"prompt": {"text": "p"}, "response": "r"}', [], ["response"]),
    11: ('{"messages": [{"role": "user"}]}', [], ["messages[].role"]),
    12: ('{"messages": "text", "output": "o"}', [], ["output"]),
    13: ("[1]", [], []),
    14: ("broken", [], []),
    15: (None, [], []),
    16: ('{"prompt": "p", "messages": []}', [], ["prompt"]),
}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(k, r, "clash") for k, (r, _, _) in RECORDS.items()]
    return spark.createDataFrame([*rows, (None, RECORDS[1][0], "x"), (None, RECORDS[1][0], "x")], "id long, j string, prompt string")


def test_records_give_their_turns_or_come_back(records):
    got: dict = {}
    for r in chat.canonical_json(records, "id", "j").orderBy("id", "turn").collect():
        got.setdefault(r.id, []).append((r.role, r.text))
    assert {k: got.get(k, []) for k in RECORDS} == {k: turns for k, (_, turns, _) in RECORDS.items()}
    assert len(got[None]) == 4
    told = {r.id: r for r in chat.layouts_json(records.where("id IS NOT NULL"), "id", "j").collect()}
    assert {k: r.unused for k, r in told.items()} == {k: unused for k, (_, _, unused) in RECORDS.items()}
    lost = chat.unmatched_json(records, "id", "j").collect()
    assert {r.id for r in lost} == {k for k, (_, turns, _) in RECORDS.items() if not turns}
    assert {r.id: r.record for r in lost} == {k: RECORDS[k][0] for k in range(10, 17)} and all(len(r.fingerprint) == 64 for r in lost)
    assert {r.fingerprint for r in lost if r.id == 10} == {chat.fingerprint(["response"])}


def test_the_fingerprint_of_a_table_selects_its_mapping(spark):
    q = [("user", "q")]
    table = spark.createDataFrame([(1, q, [("assistant", "a")])], "id long, prompt array<struct<role:string,content:string>>, completion array<struct<role:string,content:string>>")
    assert [(r.role, r.text) for r in chat.canonical(table, "id").orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    assert chat.MAPPINGS[chat.fingerprint(chat.paths(table.schema))] == 2
    more = spark.createDataFrame([(1, "p", "r", "c")], "id long, prompt string, response string, completion string")
    with pytest.warns(UserWarning, match="completion"):
        out = chat.canonical(more, "id")
    assert [(r.role, r.text) for r in out.orderBy("turn").collect()] == [("user", "p"), ("assistant", "r")]
    assert chat.MAPPINGS[chat.fingerprint(chat.paths(more.schema))] == chat.layout_of(["prompt", "response"])
    assert chat.layout_of(["prompt"]) is None and chat.layout_of(["noise"]) is None


def test_no_records(records):
    none = records.where("false")
    assert chat.canonical_json(none, "id", "j").count() == 0 and chat.layouts_json(none, "id", "j").count() == 0
