"""Shared pieces: staged tables, a distributed rank, word patterns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewater.session import shared_folder

# Fixed value: a word is a run of bytes other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` into the shared folder once and go on from the written table.

    Later jobs read the same rows whatever executors are lost meanwhile, also
    where ``df`` holds row numbers of a partition.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold at most ``rows`` rows, since each row may be a long text; smaller settings stay."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    have = int(spark.conf.get(key))
    if have <= 0 or have > rows:
        spark.conf.set(key, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """As ``bound_batches`` for the jobs that run inside; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    had = spark.conf.get(key)
    bound_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(key, had)


def plain_names(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` without names that need quotes (``a.b``), and a function that gives a result their names back."""
    odd = {c: f"_column_{i}" for i, c in enumerate(df.columns) if "." in c or "`" in c}
    if not odd:
        return df, lambda out: out
    back = {v: k for k, v in odd.items()}
    return df.toDF(*[odd.get(c, c) for c in df.columns]), lambda out: out.toDF(*[back.get(c, c) for c in out.columns])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keyed_uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Row number over the whole table (from 0) without a one-task window.

    A range sort gives every task a stretch of the order; ranks are the place
    in the stretch plus the sizes of the stretches before it. The window runs
    over one row per task only.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = stage(
        df.sort(*order).select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")),
        "rank",
    )
    from pyspark.sql import Window

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_rows.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return sorted_rows.join(offsets, "_part").select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))
