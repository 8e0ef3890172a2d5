from __future__ import annotations

from compare import connect, differences
from helpers import SF

from demandspark.llm import chat, queries

SCHEMA = "conv_id long, turn int, role string, text string, place int, one int, name string"


def test_sql_twin(spark):
    df = queries.op7_chat_rotation(spark, SF)
    assert differences(df, connect(SF), queries.ORACLE["op7_chat_rotation"]) == []


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def spoken(row):
    return [row.text[int(a) : int(b)] for a, b in (s.split(":") for s in row.mask.split(",") if s)]


def test_every_speaker_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "ann", "hi 🙂"), (1, 2, "bob", "hello"), (1, 3, "cy", "hé"), (1, 4, "ann", "bye")]
    found = {r.speaker: r for r in chat.rotate(turns(spark, rows)).collect()}
    assert set(found) == {"ann", "bob", "cy"}
    assert spoken(found["ann"]) == ["hi 🙂<|end|>\n", "bye<|end|>\n"]
    assert found["bob"].text == (
        "<|system|>\nbe brief<|end|>\n<|user|>\nann: hi 🙂<|end|>\n<|assistant|>\nhello<|end|>\n"
        "<|user|>\ncy: hé<|end|>\n<|user|>\nann: bye<|end|>\n"
    )


def test_long_dialogue_comes_in_parts(spark):
    rows = [(5, i, f"s{i % 3}", f"t{i}") for i in range(300)] + [(6, 0, "s0", "alone")]
    found = sorted(chat.rotate(turns(spark, rows).repartition(9), chat.Template(part_turns=64)).collect(), key=lambda r: (r.conv_id, r.speaker, r.part))
    long = [r for r in found if r.conv_id == 5]
    assert len(long) == 3 * 5 and max(r.n_turns for r in long) == 64
    for s in ("s0", "s1", "s2"):
        own = [x for r in long if r.speaker == s for x in spoken(r)]
        assert own == [f"t{i}<|end|>\n" for i in range(300) if f"s{i % 3}" == s]


def test_edges(spark):
    rows = [
        (None, 0, "a", "x"), (None, 1, None, None), (2, None, "a", "late"), (2, 0, "a", "first"), (2, 0, "a", "first"),
        (3, 0, "system", "only"), (4, 0, "", ""),
    ]
    found = {(r.conv_id, r.speaker): r for r in chat.rotate(turns(spark, rows)).collect()}
    assert set(found) == {(None, "a"), (None, "unknown"), (2, "a"), (4, "")}
    assert spoken(found[2, "a"]) == ["first<|end|>\n", "first<|end|>\n", "late<|end|>\n"]
    assert spoken(found[None, "unknown"]) == ["<|end|>\n"]
    assert chat.rotate(turns(spark, [])).count() == 0
