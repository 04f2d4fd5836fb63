"""Formatted conversations read back, with texts made to break the grammar."""

import random
import re

from pyspark.sql import functions as F

from headway.llm import chatgrammar

PARTS = [
    "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE:eA==>>", "<</ROLE>>", "[\\INST]", "<\\\\s>", "<<\\/SYS>>", "<", "[", "\\", "/", " ",
    "\n", "é", "ok", "s>", "INST]", "SYS>>", "ROLE", "$1", "🙂",
]


def test_round_trip_of_hard_texts(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(400):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "tool", "", "a<b>", "<s>", "R" * 90])
            rows.append((conv, turn, role, "".join(rng.choices(PARTS, k=rng.randint(0, 7))), "x"))
    rows += [(900, 0, None, None, "x"), (901, 0, "user", "hi", "x"), (901, 0, "user", "hi", "x"), (None, 1, "user", "a", "x"), (None, None, "assistant", "b", "x")]
    rows += [(902, 0, "assistant", "long " * 50000, "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(4)
    out = {r.conv_id: r for r in chatgrammar.format_conversations(frame).collect()}
    assert len(out) == len({r[0] for r in rows})
    for conv, r in out.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text, _ in rows if c == conv))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for *_, role, text in own]
        marks = re.findall(chatgrammar.MARK, r.formatted)
        assert len(marks) == 2 * len(own)  # no text holds a mark
        learned = [re.sub(chatgrammar.ESCAPED, r"\1\2\3", r.formatted[s.start : s.end]) for s in r.loss_spans]
        assert learned == [text for *_, role, text in own if role == "assistant"]


def test_plain_texts_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a < b [c]"), (1, 1, "assistant", "\\n")], "conv_id long, turn long, role string, text string")
    row = chatgrammar.format_conversations(frame).first()
    assert row.formatted == "[INST] a < b [c] [/INST]<s> \\n </s>"


def test_broken_grammar_is_null(spark):
    texts = ["[INST] a </s>", "[INST] a [/INST] ", " [INST] a [/INST]", "[INST]a [/INST]", "[INST] [/INST]", "[INST] a", "x", "", "[INST] a [/INST]"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.p is not None for r in frame.select(chatgrammar.parse(F.col("t")).alias("p")).collect()] == [False] * 8 + [True]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chatgrammar.format_conversations(frame).count() == 0
