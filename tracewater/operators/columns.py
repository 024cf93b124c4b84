"""Column-level verbs: ranges, order, renames, filters over column sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in frame order, both included."""
    start, stop = df.columns.index(first), df.columns.index(last)
    if start > stop:
        raise ValueError(f"{first} comes after {last}")
    return df.columns[start : stop + 1]


def front(df: DataFrame, *columns: str) -> DataFrame:
    """Move columns to the front, keep the others in order."""
    return df.select(*columns, *[c for c in df.columns if c not in columns])


def select_as(df: DataFrame, columns: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Select in order; ``(old, new)`` renames."""
    return df.select(
        *[F.col(f"`{c}`") if isinstance(c, str) else F.col(f"`{c[0]}`").alias(c[1]) for c in columns]
    )


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def domain_header(name: str) -> str:
    """Header rule of domain tables: blank header is the guid, first space to ``_``, lower case."""
    if name in ("", "_c0", "X1", "...1"):
        return "guid"
    return name.replace(" ", "_", 1).lower()


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def has_value(*columns: str) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"`{c}`").isNotNull()
    return condition


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every one of ``columns`` is null."""
    return df.dropna(how="all", subset=list(columns))


def match_names(df: DataFrame, column: str, patterns: Sequence[str], label: str) -> DataFrame:
    """Case-insensitive regex match of several names; one row per matching name.

    The names are given by the user, so they become literal patterns inside a
    projection: no join, and each pattern is compiled once.
    """
    hits = F.array(*[F.when(F.col(column).rlike(f"(?iu){p}"), F.lit(p)) for p in patterns])
    return df.withColumn(label, F.explode(F.filter(hits, lambda h: h.isNotNull())))


def valid_on(
    df: DataFrame,
    day: dt.date | str | None,
    begin: str = "begin_geldigheid",
    end: str = "eind_geldigheid",
) -> DataFrame:
    """Rows valid on ``day``, both bounds included; an open bound drops the row, no day keeps all."""
    if day is None:
        return df
    if begin not in df.columns or end not in df.columns:
        raise ValueError(f"no validity columns {begin}, {end} in this table")
    at = F.lit(day).cast("date")
    return df.where((F.col(begin) <= at) & (F.col(end) >= at))
