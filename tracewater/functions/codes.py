"""Business-activity codes in their three written forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_forms(code: Column, width: int = 5) -> dict[str, Column]:
    """``decimal`` (dotted), ``plain`` (no dots) and ``padded`` (zeros to ``width``).

    A one-digit group in front gets a leading zero; three digits without a dot
    after the group get their last one split off. Both decisions look at the
    text as it was written.
    """
    written = F.replace(code, F.lit(","), F.lit("."))
    digits = F.regexp_count(written, F.lit(r"\d"))
    dot = F.instr(written, ".")
    before = F.when(dot > 0, dot - 1).otherwise(0)
    prefixed = F.when((digits == 1) | (before == 1), F.concat(F.lit("0"), written)).otherwise(written)
    decimal = F.when(
        digits - before == 3, F.regexp_replace(prefixed, r"^(.*)(.)$", "$1.$2")
    ).otherwise(prefixed)
    plain = F.replace(decimal, F.lit("."), F.lit(""))
    padded = F.when(F.length(plain) < width, F.rpad(plain, width, "0")).otherwise(plain)
    return {"decimal": decimal, "plain": plain, "padded": padded}


def plain_code(decimal: Column) -> Column:
    return F.replace(decimal, F.lit("."), F.lit(""))
