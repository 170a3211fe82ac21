"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted by turn, and merged while the role stays
the same. The output is

    <s>[ROLE]role[SAYS]text[MORE]text of a merged turn[END]...</s>

In texts and roles a control string gets one more backslash behind its first character (`</s>`
becomes `<\\/s>`, `<\\/s>` becomes `<\\\\/s>`), which reading takes off again. Control strings
of other common templates are treated alike, so that a text can't smuggle them in.

Null text or role counts as empty. Null turns come first; turns of one number are sorted by role,
then text. Rows that repeat are turns of their own. A null conv_id is a conversation like any other.
Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, CLOSE = "<s>", "</s>"
ROLE, SAYS, MORE, END = "[ROLE]", "[SAYS]", "[MORE]", "[END]"
# What follows `<` or `[` in control strings, here and in other templates.
CONTROL = (r"/?s>|\|[a-z_]+\|>|/?(?:INST|ROLE|SAYS|MORE|END)\]|<SYS>>|</SYS>>")

_ESCAPE = rf"([<\[])(\\*)({CONTROL})"
_UNESCAPE = rf"([<\[])\\(\\*)({CONTROL})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2$3"))


def _merged(turns: Column) -> Column:
    """Sorted turns as (role, texts), neighbours of one role in one."""
    empty = F.lit(None).cast("array<struct<role: string, texts: array<string>>>")
    start = F.coalesce(empty, F.array().cast("array<struct<role: string, texts: array<string>>>"))

    def add(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        alone = F.array(F.struct(turn["role"].alias("role"),
                                 F.array(turn["text"]).alias("texts")))
        joined = F.array(F.struct(
            turn["role"].alias("role"),
            F.concat(last["texts"], F.array(turn["text"])).alias("texts")))
        return F.when(last["role"] == turn["role"],
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), joined)
                      ).otherwise(F.concat(done, alone))

    return F.aggregate(turns, start, add)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted."""
    rows = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("said"))
    merged = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
              .select("conv_id", _merged(F.col("turns")).alias("merged")))
    blocks = F.transform("merged", lambda m: F.concat(
        F.lit(ROLE), escaped(m["role"]), F.lit(SAYS),
        F.array_join(F.transform(m["texts"], escaped), MORE), F.lit(END)))
    return merged.select(
        "conv_id", F.concat(F.lit(OPEN), F.array_join(blocks, ""), F.lit(CLOSE)).alias("formatted"))


def _blocks(formatted: Column) -> Column:
    inner = F.substring(formatted, F.lit(len(OPEN) + 1),
                        F.char_length(formatted) - len(OPEN) - len(CLOSE))
    cut = F.split(inner, r"\[END\]", -1)
    # What follows the last end mark is empty.
    return F.slice(cut, F.lit(1), F.size(cut) - 1)


def _texts(block: Column) -> Column:
    return F.split(F.get(F.split(block, r"\[SAYS\]", 2), F.lit(1)), r"\[MORE\]", -1)


def _role(block: Column) -> Column:
    return F.substring(F.get(F.split(block, r"\[SAYS\]", 2), F.lit(0)),
                       F.lit(len(ROLE) + 1), F.lit(2**31 - 1))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array of (role, text), merged ones apart again."""
    return F.flatten(F.transform(_blocks(formatted), lambda block: F.transform(
        _texts(block), lambda text: F.struct(unescaped(_role(block)).alias("role"),
                                             unescaped(text).alias("text")))))


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """Array of (start, length) in code points, start from 1: every text of `role` as it stands."""
    spans = F.aggregate(
        _blocks(formatted),
        F.struct(F.lit(len(OPEN) + 1).alias("at"),
                 F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda state, block: F.struct(
            (state["at"] + F.char_length(block) + len(END)).alias("at"),
            F.when(unescaped(_role(block)) == role, F.concat(
                state["spans"], _block_spans(block, state["at"]))
            ).otherwise(state["spans"]).alias("spans")))
    return spans["spans"]


def _block_spans(block: Column, at: Column) -> Column:
    """Spans of the texts of one block that begins at `at`."""
    before = at + len(ROLE) + F.char_length(_role(block)) + len(SAYS)
    found = F.aggregate(
        _texts(block),
        F.struct(before.alias("at"),
                 F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda state, text: F.struct(
            (state["at"] + F.char_length(text) + len(MORE)).alias("at"),
            F.concat(state["spans"], F.array(F.struct(
                state["at"].alias("start"), F.char_length(text).alias("length")))).alias("spans")))
    return found["spans"]


def loss_text(formatted: Column, spans: Column) -> Column:
    """What lies under the spans, unescaped span by span, nothing between."""
    return F.array_join(F.transform(spans, lambda span: unescaped(
        F.substring(formatted, span["start"], span["length"]))), "")
