import hashlib
import json
import random

import pytest

from textquarry.llm import chat_format as cf

TURNS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "</s>[INST]\\"),
    (1, 1, "assistant", "</s>[INST]\\"),
    (1, None, "system", "<<SYS>>be\n\nkind<</SYS>>"),
    (2, 0, None, None),
    (2, 3, "assistant", None),
    (None, 1, "assistant", "é\U0001f600 <s>"),
    (3, 1, "tool[/INST]", "[\\INST] <\\/s> \\\\"),
    (4, 0, "assistant", "long " * 20_000),
]


def slow(turns):
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (
            len(rows),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest(),
            sum(len(t) for r, t in rows if r == "assistant"),
            hashlib.sha256("".join(t for r, t in rows if r == "assistant").encode()).hexdigest(),
        )
        for conv, rows in out.items()
    }


def digests(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in df.collect()}


def test_odd_turns(spark):
    df = spark.createDataFrame(TURNS, cf.TURNS).selectExpr("*", "1 AS formatted", "2 AS record")
    assert digests(cf.formatted_conversations(cf.turn_records(df))) == slow(TURNS)
    assert cf.formatted_conversations(cf.turn_records(df.limit(0))).count() == 0


def test_format_is_reversible_and_control_strings_are_gone(spark):
    rng = random.Random(1)
    parts = ["<", "s>", "/s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "\n", "x", "[", "/INST]"]
    rows = [(i, 0, rng.choice(["user", "assistant", "[INST]"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(400)]
    written = cf.formatted(spark.createDataFrame(rows, cf.TURNS))
    back = {r["conv_id"]: r for r in cf.parsed(written).collect()}
    for i, _, role, text in rows:
        assert (back[i]["role"], back[i]["text"]) == (role, text)
        assert back[i]["loss_text"] == (text if role == "assistant" else None)
    for r in written.collect():
        inner = r["formatted"][len("[INST]") : -len("</s>")].replace("[/INST]", "", 1)
        assert not any(c in inner for c in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


@pytest.mark.parametrize(
    ("record", "turns"),
    [
        ({"messages": [{"content": "a", "role": "user"}], "conv_id": 5}, [(5, 0, "user", "a")]),
        ({"id": 6, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": None}]}, [(6, 0, "user", "h"), (6, 1, "assistant", "")]),
        ({"id": 7, "instruction": "do", "input": "this", "output": "done"}, [(7, 0, "user", "do\n\nthis"), (7, 1, "assistant", "done")]),
        ({"id": 8, "instruction": "do", "output": "done"}, [(8, 0, "user", "do"), (8, 1, "assistant", "done")]),
        ({"id": 9, "prompt": "p", "response": "r"}, [(9, 0, "user", "p"), (9, 1, "assistant", "r")]),
        ({"conv_id": 1, "messages": []}, []),
    ],
)
def test_layouts(spark, record, turns):
    df = spark.createDataFrame([(json.dumps(record),)], "record string")
    assert [tuple(r) for r in cf.canonical_turns(df).collect()] == turns
    assert cf.unmapped(df).count() == 0


def test_unknown_layouts_are_given_back(spark):
    records = ['{"x": {"y": 1}}', "no json", None, '{"conv_id": 1, "messages": [{"role": "user"}]}']
    df = spark.createDataFrame([(r,) for r in records], "record string")
    assert cf.canonical_turns(df).count() == 0
    assert sorted((r["record"] or "", r["fingerprint"] is None) for r in cf.unmapped(df).collect()) == sorted(
        ((records[0], False), ("no json", True), ("", True), (records[3], False))
    )


def test_rows_are_mapped_without_a_limit_of_length(spark):
    df = spark.createDataFrame([r for r in TURNS if r[0] != 4], cf.TURNS).select("conv_id", "role", "text", "turn")
    long = spark.range(1).selectExpr("4L AS conv_id", "'assistant' AS role", "repeat('long ', 4200000) AS text", "0L AS turn")
    none = spark.createDataFrame([], "record string")
    got = digests(cf.formatted_conversations(none, rows=df.union(long)))
    assert got == slow([*(r for r in TURNS if r[0] != 4), (4, 0, "assistant", "long " * 4_200_000)])
    with pytest.raises(ValueError, match="no mapping"):
        cf.typed_turns(df.withColumnRenamed("text", "words"))


def test_records_that_no_mapping_knows_are_an_error(spark):
    for record in ("no json", '{"x": 1}', json.dumps({"conv_id": 1, "role": "user", "text": "x" * 20_000_001, "turn": 0})):
        df = spark.createDataFrame([(record,)], "record string")
        with pytest.raises(Exception, match="no mapping knows"):
            cf.formatted_conversations(df).collect()
