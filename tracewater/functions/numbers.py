"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def tolerant_double(col: Column) -> Column:
    """Text to number; text that is no number gives null."""
    text = col.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def tolerant_int(col: Column) -> Column:
    """Text to whole number, cut towards zero; bad or too large gives null."""
    return tolerant_double(col).try_cast("int")


def annual_load(median: Column, digits: int = 2) -> Column:
    """Yearly load in kg from a median daily load in mg."""
    return F.round(median * F.lit(365) / F.lit(1_000_000), digits)
