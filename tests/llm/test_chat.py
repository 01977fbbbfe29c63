"""Chat formatting: any text comes back, hostile ones included, and the mask covers the assistant's texts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_parse(formatted: str):
    """The grammar in plain Python, one character after the other."""

    def undo(text, controls):
        for c in controls:
            out, i = [], 0
            while i < len(text):
                j = i + 1
                while text[i] == c[0] and j < len(text) and text[j] == "\\":
                    j += 1
                if text[i] == c[0] and j > i + 1 and text.startswith(c[1:], j):
                    out.append(c[0] + "\\" * (j - i - 2) + c[1:])
                    i = j + len(c) - 1
                else:
                    out.append(text[i])
                    i += 1
            text = "".join(out)
        return text

    turns = []
    while formatted:
        assert formatted.startswith("### ")
        end = formatted.index("</turn>")
        head, _, body = formatted[4:end].partition(": ")
        turns.append((undo(head, ("### ", "</turn>", ": ")), undo(body, ("### ", "</turn>"))))
        assert formatted[end + 7] == "\n"
        formatted = formatted[end + 8 :]
    return turns


def hostile_rows():
    rng = random.Random(5)
    parts = ["### ", "#", "\\", "</turn>", "<", "/turn>", "\n", ": ", ":", " ", "user", "é😀", "assistant", "<\\/turn>", "#\\## "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "".join(rng.choices(parts, k=4))]), "".join(rng.choices(parts, k=rng.randrange(9))))
            for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(100, 0, None, None), (100, None, "user", "first"), (100, None, "assistant", ""), (None, 3, "user", "no id"), (None, 1, "assistant", "x")]
    rows += [(101, 2, "user", "same"), (101, 2, "user", "same"), (101, 2, "assistant", "tie"), (102, 0, "assistant", "long ### " * 40_000)]
    return rows


@pytest.fixture(scope="module")
def chats(spark):
    rows = spark.createDataFrame(hostile_rows(), SCHEMA).selectExpr("*", "1 AS formatted", "'x' AS `a.b`", "2 AS turns").repartition(5)
    return {r.conv_id: r for r in chat.read_chats(chat.format_chats(rows)).collect()}, {
        r.conv_id: r for r in chat.format_chats(rows).collect()
    }


def test_everything_comes_back(chats):
    read, written = chats
    groups: dict = {}
    for c, t, role, text in hostile_rows():
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert read.keys() == groups.keys()
    for c, rows in groups.items():
        want = [(role, text) for _, _, role, text in sorted(rows)]
        assert [tuple(t) for t in read[c].turns] == want == plain_parse(written[c].formatted)
        assert read[c].learnt == [text if role == "assistant" else "" for role, text in want]
        assert sum(sum(m) for m in written[c].loss_mask) == len(written[c].formatted)


def test_plain_texts_stay_as_they_are(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a \\ b: <c> #1 \\n"), (1, 1, "assistant", "fine")], SCHEMA)
    assert chat.format_chats(rows).first().formatted == "### user: a \\ b: <c> #1 \\n</turn>\n### assistant: fine</turn>\n"


def test_empty_table(spark):
    assert chat.read_chats(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("bad", ["", "### user: x", "x### user: y</turn>\n", "### user y</turn>\n", "### user: a</turn>\nb</turn>\n"])
def test_other_texts_are_refused(spark, bad):
    found = spark.createDataFrame([(bad,)], "t string").select(chat.parse(F.col("t")).alias("p")).first().p
    assert found is None or (bad == "" and found == [])


def test_query_equals_sql(spark, sf_dir):
    from compare import difference, duck

    assert difference(spark, duck(sf_dir), "op11_chat_format", sf_dir) is None
    plan = __import__("martloom.llm.queries", fromlist=["q"]).op11_chat_format(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
