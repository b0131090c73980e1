"""Formatted conversations against a plain version, on texts made of marks and escapes."""

import random

import pytest
from pyspark.sql import functions as F

from windrow.llm import chat, columns

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, loss string"


def plain(rows):
    """Formatted text, turns and learned text of each conversation, by string methods."""
    conversations = {}
    for conv, turn, role, text, *_ in rows:
        key = (turn is not None, turn or 0, role or "", text or "")
        conversations.setdefault(conv, []).append(key)
    found = {}
    for conv, turns in conversations.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        out, before = "", None
        for role, text in turns:
            safe = [x.replace("\\", "\\\\").replace("<turn>", "\\lturn>").replace("</turn>", "\\l/turn>").replace("<part/>", "\\lpart/>") for x in (role, text)]
            if role == before:
                out += "<part/>" + safe[1]
            else:
                out += ("" if before is None else "</turn>\n") + "<turn>" + safe[0].replace("\n", "\\n") + "\n" + safe[1]
            before = role
        found[conv] = (out + "</turn>\n", turns, "".join(t for r, t in turns if r == "assistant"))
    return found


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    bits = ["<turn>", "</turn>", "<part/>", "\\", "\\l", "\\n", "l", "n", "<", "/turn>", "turn>", "\n", "</turn>\n", "### Assistant:", "é", "😀", " ", "ok"]

    def text():
        return "".join(draw.choice(bits) for _ in range(draw.randrange(12)))

    roles = ["user", "assistant", "assistant", "system", None, "a\nb", "<turn>\\", ""]
    made = [(draw.randrange(40), draw.choice([0, 1, 2, 3, 4, None]), draw.choice(roles), text(), "x", "y") for _ in range(600)]
    long = [(100, i, ["user", "assistant"][i // 3 % 2], text() * 40, "x", "y") for i in range(1500)]
    odd = [(101, 0, "assistant", None, "x", "y"), (None, 1, "user", "no id", "x", "y"), (None, 0, "assistant", "", "x", "y"), (102, 0, "assistant", "é" * 70000, "x", "y")]
    return made + made[:50] + long + odd


def test_format_and_back(spark, rows):
    expected = plain(rows)
    found = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["conv_id", "formatted", "loss"]
    read = found.select("*", chat.turns_of(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    got = {r.conv_id: r for r in read.collect()}
    assert got.keys() == expected.keys()
    for conv, (formatted, turns, learned) in expected.items():
        assert got[conv].formatted == formatted
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].learned == learned
        assert all(0 <= s.start <= s.stop <= len(formatted) for s in got[conv].loss)
        assert len(got[conv].loss) == sum(r == "assistant" for r, _ in turns)


def test_no_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_running_sums_and_cuts(spark):
    draw = random.Random(2)
    numbers = [[draw.randrange(9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 5000)]
    text = "".join(draw.choice("ab é😀\n") for _ in range(5000))
    spans = [tuple(sorted((draw.randrange(5001), draw.randrange(5001)))) for _ in range(200)] + [(0, 0), (1024, 2048), (0, 5000), (1023, 1025)]
    got = spark.createDataFrame([(n,) for n in numbers], "n array<int>").select("n", columns.running_sums(F.col("n")).alias("s")).collect()
    assert all([sum(r.n[: i + 1]) for i in range(len(r.n))] == r.s for r in got)
    df = spark.createDataFrame([(text, spans)], "text string, spans array<struct<start:long,stop:long>>")
    assert df.select(columns.cut(F.col("text"), F.col("spans")).alias("c")).first().c == [text[a:b] for a, b in spans]
