"""Chat formatting: escapes, parts, loss masks; the query against its SQL."""

import random

import pytest
from pyspark.sql import functions as F

from invspark.llm import chat, queries
from tests.compare import differences, oracle

SCHEMA = f"conv_id long, turn long, role string, parts array<{chat.PART}>"


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_escapes_are_reversible_and_leave_no_control(spark):
    rng = random.Random(6)
    bits = [*chat.CONTROLS, "\\", "[", "]", "<", ">", "/", "ROLE", "s", "\n", "é", "\\[", "[\\"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for row in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert row.u == row.t and not any(c in row.e for c in chat.CONTROLS)


def test_parts_are_flattened_in_order(spark):
    content = [
        part(text="see "), part("image", ref="a.png", width=57, height=28), part(text=" and [IMG] "), part("audio", ref="b.wav", seconds=1.5), None,
        part("document", ref="c.pdf", pages=3), part("image", ref="d.png"), part("video", text="odd"), part(None, text="!"), part(),
    ]
    rows = [(1, 0, "user", content), (1, 1, "assistant", [part(text="ok")]), (2, 0, None, None), (2, 0, None, None), (None, None, "assistant", [part(text="x")])]
    found = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, SCHEMA)).collect()}
    one = found[1]
    assert one.formatted == "<s>[ROLE]user[SAYS]see [IMG] and [\\IMG] [AUDIO][DOC][IMG]odd!</s>[ROLE]assistant[SAYS]ok</s>"
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("image", "d.png", 1)]
    assert one.expanded_tokens == 3 + 38 + 768 + 1
    assert [one.formatted[s.start : s.start + s.length] for s in one.loss] == ["ok"]
    assert found[2].formatted == "<s>" + "[ROLE][SAYS]</s>" * 2 and found[2].loss == []
    assert found[None].formatted == "<s>[ROLE]assistant[SAYS]x</s>" and len(found[None].loss) == 1


def test_many_turns_and_code_points(spark):
    said = ["🙂" * (i % 5) + "</s>" + str(i) for i in range(1000)]
    rows = [(7, i, "assistant" if i % 2 else "user", [part(text=t)]) for i, t in enumerate(said)]
    out = chat.render(spark.createDataFrame(rows, SCHEMA).repartition(5))
    row = out.select("formatted", "loss", chat.turns(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("under")).first()
    assert [t.text for t in row.turns] == said and row.under == "".join(said[1::2])
    assert all(row.formatted[s.start : s.start + s.length] == t.replace("</s>", "<\\/s>") for s, t in zip(row.loss, said[1::2]))


def test_empty_table(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    assert not differences(queries.QUERIES["op3_chat_formatting"](spark, sf), oracle(sf), queries.SQL["op3_chat_formatting"])
