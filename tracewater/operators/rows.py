"""Row sets: difference, appends, distinct projections, repeated keys, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right``; nulls compare equal.

    One grouping over both sides: each task folds repeated rows before the
    single shuffle, so heavy repeats cost nothing, and no join is needed.
    """
    columns = left.columns
    sided = left.withColumn("__seen", F.lit(0)).unionByName(right.select(*columns).withColumn("__seen", F.lit(1)))
    return sided.groupBy(*columns).agg(F.max("__seen").alias("__seen")).where(F.col("__seen") == 0).drop("__seen")


def append(*frames: DataFrame) -> DataFrame:
    """Append by name; every frame must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_widen(*frames: DataFrame) -> DataFrame:
    """Append by name, filling absent columns with null and widening numbers."""
    widest: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            known = widest.get(field.name)
            widest[field.name] = field.dataType if known is None else _wider(field.name, known, field.dataType)
    cast = [
        f.select(*[F.col(f"`{c}`").cast(widest[c]).alias(c) for c in f.columns]) for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def _wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _NUMERIC_RANK and type(b) in _NUMERIC_RANK:
        return max(a, b, key=lambda t: _NUMERIC_RANK.index(type(t)))
    raise TypeError(f"{name}: cannot append {b.simpleString()} to {a.simpleString()}")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys seen more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def first_of_rest(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Group by every other column and keep the first ``value``, null included.

    ``order`` columns decide which is first and are not part of the group,
    unless ``order`` is ``value`` itself.
    """
    rest = [c for c in df.columns if c != value and c not in order]
    ranked = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in order])
    return df.groupBy(*rest).agg(F.min_by(value, ranked).alias(value))


def coverage(df: DataFrame, matched: Column, keys: Sequence[str], by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Match report in one pass: rows, matched, unmatched, share in %, distinct keys.

    A missing key counts as one distinct value.
    """
    hit = F.count_if(matched)
    total = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        total.alias("n_rows"),
        hit.alias("n_matched"),
        (total - hit).alias("n_unmatched"),
        F.round(F.when(total > 0, 100.0 * hit / total), digits).alias("matched_pct"),
        *[
            (F.count_distinct(F.col(k)) + F.coalesce(F.max(F.col(k).isNull().cast("int")), F.lit(0))).alias(f"n_{k}")
            for k in keys
        ],
    )
