"""First-row logic, duplicate marks and top-k.

``row_number``/``rank`` under a bound becomes a WindowGroupLimit: every input
task keeps only the candidates of each key before the shuffle, so a hot key
sends at most a few rows per task over the network.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewater.operators.joins import in_set, null_safe_join
from tracewater.operators.order import nulls_last
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], drop_null_keys: bool = False
) -> DataFrame:
    """The first row per key under an explicit order; null is one key value."""
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*nulls_last(order)))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def keep_first_chain(df: DataFrame, key_steps: Sequence[Sequence[str]], order: Sequence[str | Column]) -> DataFrame:
    """``keep_first`` by each key in turn, on the survivors of the step before."""
    for keys in key_steps:
        df = keep_first(df, keys, order)
    return df


def mark_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = "is_duplicate",
    null_is_value: bool = True,
    known_flag: str | None = None,
) -> DataFrame:
    """Flag every row, first and last included, whose key occurs more than once.

    Counting with a window would send a whole hot key to one task. The keys
    are counted with map-side aggregation instead and only repeated keys, one
    row each, are joined back. ``known_flag`` adds the flag that never counts
    a null key as repeated; both come from one count and one join, which can
    then be split at run time, since nothing stands between it and its
    exchanges.
    """
    counted = df if null_is_value or known_flag else df.dropna(subset=list(keys))
    repeated = (
        counted.groupBy(*keys).count().where(F.col("count") > 1).select(*keys, F.lit(True).alias("__repeated"))
    )
    marked = null_safe_join(df, repeated, list(keys))
    again = F.coalesce(F.col("__repeated"), F.lit(False))
    known = again & reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    flags = {flag: again if null_is_value else known}
    if known_flag:
        flags[known_flag] = known
    return marked.withColumns(flags).drop("__repeated")


def top_k_with_ties(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows per group, plus every row tied with the k-th.

    Any number of rows may tie, so groups are not ranked row by row. ``df`` is
    written out once, since order values that are sums of doubles need not
    come out bit for bit the same twice. Equal rows are folded to their order
    values with a count; the first ``k`` values of a group hold the answer (cut
    before the shuffle for ``k`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, and after it beyond);
    and the rows are kept by a semi join on those values.
    """
    df = write_stage(df, shared_folder(df.sparkSession, "ranked"))
    values = [c.removeprefix("-") for c in order]
    counted = df.groupBy(*by, *values).agg(F.count(F.lit(1)).alias("__n"))
    in_order = Window.partitionBy(*by).orderBy(*nulls_last(order))
    leading = counted.withColumn("__place", F.row_number().over(in_order)).where(F.col("__place") <= k)
    before = F.coalesce(F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return in_set(df, leading.withColumn("__before", before).where(F.col("__before") < k), [*by, *values])
