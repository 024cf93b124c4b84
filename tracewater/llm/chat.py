"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is written as ``<turn ROLE>``, a line end, the text, a line end and
``</turn>`` with a line end. Control strings inside texts and roles are escaped
reversibly: a backslash is doubled, the ``<`` of ``<turn`` and ``</turn``
becomes ``\\l``; in roles ``>`` becomes ``\\g`` and a line end ``\\n``.

Every assistant turn makes one example: all turns before it as context, then
the reply, which alone is trainable (the loss span). A conversation that does
not end with an assistant turn makes one more example of all its turns without
a loss span, so that no turn is lost.

Cases: a null text or role is empty. Turns go by number, null first; equal
numbers by role, then text; repeated rows are turns of their own. The null
conversation is one conversation. A conversation of one turn, empty texts and
an empty table need nothing special. Extra columns are not read. The text of an
example is as long as its prefix, so a conversation is expanded by one task,
one example at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    opened = F.replace(doubled, F.lit("<turn"), F.lit("\\lturn"))
    return F.replace(opened, F.lit("</turn"), F.lit("\\l/turn"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undo both escapes: between doubled backslashes a single one always starts a code."""

    def codes(part: Column) -> Column:
        for code, plain in (("\\l", "<"), ("\\g", ">"), ("\\n", "\n")):
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), codes), "\\")


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` -> ``conv_id, example, n_turns, complete, formatted, loss_start, loss_length``.

    ``loss_start`` and ``loss_length`` count code points from 0; an example
    without trainable text has null in both. ``complete`` marks the example
    that holds all turns.
    """
    clean = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    written = whole.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(HEAD_END), escape(t["text"]), F.lit(CLOSE)),
        ).alias("parts"),
        F.transform("turns", lambda t: t["role"] == TRAINABLE).alias("trainable"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("trainable")),
        lambda i: F.element_at("trainable", i) | (i == F.size("trainable")),
    )
    each = written.select("*", F.posexplode(ends).alias("example", "end"))
    formatted = each.select(
        "conv_id",
        "example",
        F.col("end").cast("long").alias("n_turns"),
        (F.col("end") == F.size("parts")).alias("complete"),
        F.array_join(F.slice("parts", F.lit(1), F.col("end")), "").alias("formatted"),
        F.when(F.element_at("trainable", F.col("end")), F.element_at("lengths", F.col("end"))).alias("loss_length"),
    )
    return formatted.select(
        "conv_id",
        "example",
        "n_turns",
        "complete",
        "formatted",
        (F.length("formatted") - len(CLOSE) - F.col("loss_length")).alias("loss_start"),
        "loss_length",
    )


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, as it was before escaping."""
    return unescape(F.substring(formatted, start + 1, length))


def read_turns(formatted: Column) -> Column:
    """An example's turns, read back: array of ``role, text``."""
    parts = F.split(formatted, CLOSE)

    def turn(part: Column) -> Column:
        at = F.instr(part, HEAD_END)
        return F.struct(
            unescape(F.substring(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
            unescape(F.substring(part, at + len(HEAD_END), F.length(part))).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)
