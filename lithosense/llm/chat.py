"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is written as

    <|im_start|>role<|im_sep|>text<|im_end|>⏎   (one per turn)

and read back by a deterministic parser: cut at the end mark, drop the start mark, cut at
the separator, undo escapes.  The grammar allows no control string inside a role or text;
a part that holds one makes the turn unreadable.  Rendering goes through levels: nothing
escaped, texts escaped, texts and roles escaped.  The first level whose parse equals the
source is kept; the last always is.

Escaping doubles the escape sign and puts one behind the first character of every control
string, so it changes nothing in a text that holds neither.

Null roles and texts are empty.  Rows of one conversation are ordered by turn, then role,
then text (null turns first), so ties and repeated rows have one order.  A null
conversation id is a conversation of its own.  An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Control strings of the templates in common use.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ESCAPE = "␛"

_BARE = "|".join(re.escape(c) for c in CONTROL)
# the first character of every whole control string
_INNER = "|".join(f"({re.escape(first)})(?={'|'.join(re.escape(c[1:]) for c in CONTROL if c[0] == first)})" for first in "<[")


def escape(value: Column) -> Column:
    doubled = F.regexp_replace(value, ESCAPE, ESCAPE * 2)
    return F.regexp_replace(doubled, _INNER, f"$1$2{ESCAPE}")


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, f"{ESCAPE}({ESCAPE}?)", "$1")


def render(turns: Column, role=lambda c: c, text=lambda c: c) -> Column:
    """One string from an array of (role, text)."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(START), role(t["role"]), F.lit(SEPARATOR), text(t["text"]), F.lit(END + "\n"))), ""
    )


def parse(formatted: Column) -> Column:
    """The array of (role, text) of a rendered string; unreadable parts are null."""
    pieces = F.split(formatted, re.escape(END) + "\n", -1)
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def clean(part: Column) -> Column:
        return F.when(~part.rlike(_BARE), unescape(part))

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        parts = F.split(body, re.escape(SEPARATOR), 2)
        return F.struct(clean(parts[0]).alias("role"), clean(F.try_element_at(parts, F.lit(2))).alias("text"))

    return F.transform(whole, turn)


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``level`` of escaping, ``turns`` as read back.

    ``identical`` says that what was read back equals the source (it always does).
    """
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    source = F.transform(F.array_sort(F.collect_list("row")), lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    conversations = rows.groupBy("conv_id").agg(source.alias("source"))
    turns = F.col("source")
    raw, texts, full = render(turns), render(turns, text=escape), render(turns, role=escape, text=escape)
    level = F.when(parse(raw) == turns, 0).when(parse(texts) == turns, 1).otherwise(2)
    chosen = F.when(F.col("level") == 0, raw).when(F.col("level") == 1, texts).otherwise(full)
    return (
        conversations.withColumn("level", level)
        .withColumn("formatted", chosen)
        .withColumn("turns", parse(F.col("formatted")))
        .select("conv_id", "formatted", "level", "turns", (F.col("turns") == turns).alias("identical"))
    )


def loss_text(turns: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """The text under the loss mask, unescaped: each text of these roles, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"].isin(*roles)), lambda t: t["text"]), "")


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of what was read back: per conversation ``n_turns``, ``turns_sha256``, loss and lengths."""
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.withColumn("loss", loss_text(F.col("turns"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
