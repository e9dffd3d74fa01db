"""Chat formatting with Spark expressions only: turns of a conversation become one marked text.

The turns are collected as structs, sorted, adjacent turns of one role are merged into a block by
array functions, and the blocks are concatenated::

    <<SYS>> text <</SYS>>[INST] text [TURN] text [/INST]<s> text </s>[ROLE 746F6F6C] text [/ROLE]

A role other than system, user and assistant is written in hexadecimal.  A control string inside a
text gets a backslash in front, and backslashes that stand before it are doubled, so the text can
be read back exactly; :func:`read_turns` does so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"</?s>|<</?SYS>>|\[/?INST\]|\[TURN\]|\[ROLE [0-9A-F]*\]|\[/ROLE\]"
SEPARATOR = " [TURN] "
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
_CLOSE = r" (?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])"
_OPEN = r"^(<<SYS>>|\[INST\]|<s>|\[ROLE ([0-9A-F]*)\]) "


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({CONTROL})", r"$1$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(?=\\++(?:{CONTROL}))(\\*)\1\\({CONTROL})", r"$1$2")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, even where ``use`` has lambdas."""
    return F.transform(F.array(value), use)[0]


def _mark(role: Column, k: int) -> Column:
    other = F.concat(F.lit("[ROLE "), F.hex(role.cast("binary")), F.lit("] ")) if k == 0 else F.lit(" [/ROLE]")
    out = F.when(role == "system", F.lit(MARKS["system"][k]))
    for name in ("user", "assistant"):
        out = out.when(role == name, F.lit(MARKS[name][k]))
    return out.otherwise(other)


def _blocks(turns: Column) -> Column:
    """Sorted turns -> array of (role, texts), adjacent turns of one role merged."""

    def cut(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(t))
        starts = F.filter(places, lambda i: (i == 1) | (F.element_at(t, F.greatest(i - 1, F.lit(1)))["role"] != F.element_at(t, i)["role"]))
        return _let(
            starts,
            lambda s: F.transform(
                s,
                lambda at, k: F.struct(
                    F.element_at(t, at)["role"].alias("role"),
                    F.transform(
                        F.slice(t, at, F.coalesce(F.try_element_at(s, k + 2), F.size(t) + 1) - at), lambda x: x["text"]
                    ).alias("texts"),
                ),
            ),
        )

    return _let(turns, cut)


def _segments(block: Column) -> Column:
    """A block as (text, in_loss) pieces; the pieces under the loss are the assistant's texts alone."""
    plain = lambda text: F.struct(text.alias("text"), F.lit(False).alias("in_loss"))
    role = block["role"]
    body = F.flatten(
        F.transform(
            block["texts"],
            lambda text, i: F.concat(
                F.when(i > 0, F.array(plain(F.lit(SEPARATOR)))).otherwise(F.array(plain(_mark(role, 0)))),
                F.array(F.struct(escape(text).alias("text"), (role == "assistant").alias("in_loss"))),
            ),
        )
    )
    return F.concat(body, F.array(plain(_mark(role, 1))))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``segments``.

    ``segments`` are the pieces of ``formatted`` in order, each with ``in_loss``: whether the piece
    counts for the training loss.  A NULL role or text counts as empty, a NULL turn comes first,
    equal turn numbers are ordered by role and text, repeated rows stay, a NULL conversation id is
    a conversation of its own.  Other columns are left out.  No rows give no rows.
    """
    each = turns.select(
        F.col(conv).alias("_conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    grouped = each.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    blocks = grouped.select("_conv", _blocks(F.col("_turns")).alias("_blocks"))
    cut = blocks.select(F.col("_conv").alias(conv), F.flatten(F.transform("_blocks", _segments)).alias("segments"))
    return cut.select(
        conv, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""

    def turns(block: Column) -> Column:
        mark = F.regexp_extract(block, _OPEN, 1)
        role = (
            F.when(mark == "<<SYS>>", F.lit("system"))
            .when(mark == "[INST]", F.lit("user"))
            .when(mark == "<s>", F.lit("assistant"))
            .otherwise(F.unhex(F.regexp_extract(block, _OPEN, 2)).cast("string"))
        )
        body = F.substring(block, F.length(mark) + 2, F.length(block))
        return _let(
            role,
            lambda r: F.transform(
                F.split(body, r" \[TURN\] "), lambda t: F.struct(r.alias("role"), unescape(t).alias("text"))
            ),
        )

    blocks = F.split(formatted, _CLOSE)
    return F.flatten(F.transform(F.filter(blocks, lambda b: b != ""), turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    own = F.filter(segments, lambda s: s["in_loss"])
    return F.array_join(F.transform(own, lambda s: unescape(s["text"])), "")
