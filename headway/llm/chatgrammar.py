r"""Chat formatting by a grammar that is read back.

A turn is an opening mark, a space, its text, a space and a closing mark; nothing stands between turns:

    user       [INST] text [/INST]
    assistant  <s> text </s>
    system     <<SYS>> text <</SYS>>
    other      <<ROLE:name in base64>> text <</ROLE>>

The parser cuts a formatted conversation at every mark and wants an opening and its closing mark by turns. In texts,
`[\INST]`, `<\s>` and the like stand for a mark: reading takes one backslash away, however many there are.

A conversation is first formatted as it is and read back. Turns that do not come back alike (their text holds a mark, or
something that reads as an escaped one) are escaped, by one more backslash in every mark-like string, and the whole is read
again; a conversation that would still differ fails the query. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = r"\[/?INST\]|</?s>|<</?SYS>>|<<ROLE:[A-Za-z0-9+/=]*>>|<</ROLE>>"
LIKE = r"([\[<]<?)(\\*)(/?(?:s>|INST\]|SYS>>|ROLE))"
ESCAPED = r"([\[<]<?)\\(\\*)(/?(?:s>|INST\]|SYS>>|ROLE))"
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, LIKE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _by_role(role: Column, other: Column, side: int) -> Column:
    out = other
    for name, marks in MARKS.items():
        out = F.when(role == name, marks[side]).otherwise(out)
    return out


def opening(role: Column) -> Column:
    # Without line breaks, which base64() puts in after 76 characters.
    return _by_role(role, F.concat(F.lit("<<ROLE:"), F.regexp_replace(F.base64(F.encode(role, "UTF-8")), r"\s", ""), F.lit(">>")), 0)


def closing(role: Column) -> Column:
    return _by_role(role, F.lit("<</ROLE>>"), 1)


def render(role: Column, text: Column) -> Column:
    return F.concat(opening(role), F.lit(" "), text, F.lit(" "), closing(role))


def render_all(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: render(t["role"], t["text"])), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def cut(formatted: Column) -> Column:
    """Struct of the marks of a text, and of the texts before, between and after them."""
    marks = lambda t: F.regexp_extract_all(t, F.lit(MARK), F.lit(0)).alias("marks")
    return let(formatted, lambda t: F.struct(marks(t), F.split(t, MARK, -1).alias("between")))


def _role(mark: Column) -> Column:
    named = F.decode(F.unbase64(F.regexp_extract(mark, "^<<ROLE:(.*)>>$", 1)), "UTF-8")
    out = F.when(mark.startswith("<<ROLE:"), named)
    for name, (open_mark, _) in MARKS.items():
        out = F.when(mark == open_mark, F.lit(name)).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation; null if it breaks the grammar."""

    def turn(mark: Column, before: Column, text: Column, after: Column) -> Column:
        def whole(own: Column) -> Column:
            fine = (after == closing(own)) & (before == "") & (F.length(text) >= 2) & text.startswith(" ") & text.endswith(" ")
            inner = text.substr(F.lit(2), F.length(text) - 2)
            return F.when(fine, F.struct(own.alias("role"), unescape(inner).alias("text")))

        return let(_role(mark), whole)

    def read(parts: Column) -> Column:
        marks, between = parts["marks"], parts["between"]
        numbers = F.sequence(F.lit(0), (F.floor(F.size(marks) / 2) - 1).cast("int"))
        each = F.transform(
            numbers, lambda i: turn(F.get(marks, 2 * i), F.get(between, 2 * i), F.get(between, 2 * i + 1), F.get(marks, 2 * i + 1))
        )
        paired = (F.size(marks) > 1) & (F.size(marks) % 2 == 0) & (F.element_at(between, -1) == "")
        return let(F.when(paired, each), lambda turns: F.when(~F.exists(turns, lambda t: t.isNull()), turns))

    return let(cut(formatted), read)


def format_conversations(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: `id`, formatted, turns (role and text, read back) and loss_spans of assistant texts.

    Turns are in order of `turn` (null first), then role and text, so repeated rows stay, side by side. Null roles and texts
    become empty. Rows without an id make up one conversation with a null id. `loss_spans` are (start, end) in code points
    of `formatted`, end exclusive. An empty table gives an empty one; other columns are not read. A conversation is one row
    of the result and so is gathered in one row: it must fit into one, as its formatted text must.
    """
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    gathered = rows.groupBy(F.col(id).alias("id")).agg(F.array_sort(F.collect_list(one)).alias("all"))
    turns = gathered.select("id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    first = turns.withColumn("plain", render_all(F.col("turns")))
    first = first.withColumn("same", F.coalesce(parse(F.col("plain")) == F.col("turns"), F.lit(False)))

    def safe(t: Column) -> Column:
        alone = F.coalesce(parse(render(t["role"], t["text"])) == F.array(t), F.lit(False))
        return F.struct(t["role"].alias("role"), F.when(alone, t["text"]).otherwise(escape(t["text"])).alias("text"))

    again = first.withColumn("formatted", F.when(F.col("same"), F.col("plain")).otherwise(render_all(F.transform("turns", safe))))
    read = again.withColumn("back", parse(F.col("formatted")))
    unlike = F.raise_error(F.concat(F.lit("a conversation does not come back alike: "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    checked = read.select(
        "id", "formatted", F.when(F.coalesce(F.col("back") == F.col("turns"), F.lit(False)), F.col("back")).otherwise(unlike).alias("turns")
    )
    return checked.select(F.col("id").alias(id), "formatted", "turns", loss_spans(F.col("formatted")).alias("loss_spans"))


def loss_spans(formatted: Column) -> Column:
    """Places of assistant texts in a formatted conversation, as an array of (start, end)."""
    kind = "struct<at: int, spans: array<struct<start: int, end: int>>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans")).cast(kind)

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["mark"])
        span = F.struct((start + 1).alias("start"), (start + F.length(part["text"]) - 1).alias("end"))
        spans = F.when(part["mark"] == "<s>", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((start + F.length(part["text"])).alias("at"), spans.alias("spans")).cast(kind)

    def pairs(parts: Column) -> Column:
        texts = F.slice(parts["between"], 2, F.greatest(F.size(parts["marks"]), F.lit(0)))
        return F.zip_with(parts["marks"], texts, lambda m, t: F.struct(m.alias("mark"), t.alias("text")))

    return F.aggregate(let(cut(formatted), pairs), begin, step)["spans"]


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    parts = F.transform(spans, lambda s: unescape(formatted.substr(s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(parts, "")
