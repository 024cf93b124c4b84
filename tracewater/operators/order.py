"""Sorting with missing values last in both directions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nulls_last(keys: Sequence[str | Column]) -> list[Column]:
    """``"a"`` ascends, ``"-a"`` descends; Columns pass through as given."""
    out = []
    for key in keys:
        if isinstance(key, Column):
            out.append(key)
        elif key.startswith("-"):
            out.append(F.col(f"`{key[1:]}`").desc_nulls_last())
        else:
            out.append(F.col(f"`{key}`").asc_nulls_last())
    return out


def sort_nulls_last(df: DataFrame, *keys: str | Column, tie_break: Sequence[str] = ()) -> DataFrame:
    """Global sort, nulls last.

    ``tie_break`` columns take part in the range partitioning too, so a sort
    value shared by many rows is cut into several ranges.
    """
    return df.orderBy(*nulls_last([*keys, *tie_break]))
