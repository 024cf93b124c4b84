"""Long to wide, group texts, and parallel explode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.functions.text import tidy_list


def pivot_flags(df: DataFrame, ids: Sequence[str], code: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Wide 1/null matrix: one column per listed code."""
    wide = df.groupBy(*ids).pivot(code, list(values)).agg(F.first(F.lit(1)))
    return wide.select(*ids, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def pivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    status: str,
    values: Mapping[str, str],
    measures: Sequence[str],
    flags: bool = True,
) -> DataFrame:
    """One row per id, columns ``measure_label`` for each status, and a 1/null flag per status.

    ``values`` maps a status to its label; absent statuses still give columns.
    All cells come from one aggregation, hence one shuffle.
    """
    cells = [
        F.max(F.when(F.col(status) == v, F.col(m))).alias(f"{m}_{label}")
        for m in measures
        for v, label in values.items()
    ]
    wide = df.groupBy(*ids).agg(*cells)
    if not flags:
        return wide
    return wide.withColumns(
        {label: F.when(F.col(f"{measures[0]}_{label}").isNotNull(), 1) for label in values.values()}
    )


def group_text(
    df: DataFrame, ids: Sequence[str], tag: str, out: str, first_tag: str | None = None, separator: str = ", "
) -> DataFrame:
    """All tags of an id in one text, ``first_tag`` leading, the others sorted.

    Rows are made distinct on (id, tag) first; what reaches a task per id is
    the set of different tags, which is also what the text has to hold.
    """
    rank = F.when(F.col(tag) == F.lit(first_tag), 0).otherwise(1) if first_tag is not None else F.lit(1)
    tags = F.array_sort(F.collect_list(F.when(F.col(tag).isNotNull(), F.struct(rank.alias("r"), F.col(tag).alias("t")))))
    text = F.array_join(F.transform(tags, lambda t: t["t"]), separator)
    return df.select(*ids, tag).distinct().groupBy(*ids).agg(text.alias(out))


def explode_parallel(
    df: DataFrame, columns: Mapping[str, str], on_mismatch: str = "error", position: str | None = None
) -> DataFrame:
    """Split several list columns side by side, one row per position.

    ``columns`` maps a column to its separator. A list of one value is
    repeated to the longest length. Other length differences raise an error,
    or with ``on_mismatch="null"`` are padded with null.
    """
    names = list(columns)
    kept = [c for c in df.columns if c not in names]
    parts = {n: F.coalesce(tidy_list(F.col(n), sep), F.array(F.lit(None).cast("string"))) for n, sep in columns.items()}
    df = df.withColumns({f"__{n}": parts[n] for n in names})
    sizes = {n: F.size(f"__{n}") for n in names}
    longest = F.greatest(*sizes.values()) if len(names) > 1 else sizes[names[0]]

    def fitted(n: str) -> Column:
        own = F.col(f"__{n}")
        uneven = own if on_mismatch == "null" else F.raise_error(
            F.concat(F.lit(f"{n}: list of length "), sizes[n], F.lit(" beside one of length "), longest)
        ).cast("array<string>")
        return F.when(sizes[n] == longest, own).when(
            sizes[n] == 1, F.array_repeat(F.element_at(own, 1), longest)
        ).otherwise(uneven)

    zipped = F.arrays_zip(*[fitted(n).alias(n) for n in names])
    if position:
        long = df.select(*kept, F.posexplode(zipped).alias(position, "__v"))
    else:
        long = df.select(*kept, F.explode(zipped).alias("__v"))
    return long.select(*[c for c in long.columns if c != "__v"], *[F.col("__v")[n].alias(n) for n in names])


def uneven_lists(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """How many rows hold lists of lengths that cannot be paired."""
    sizes = [F.coalesce(F.size(tidy_list(F.col(n), sep)), F.lit(1)) for n, sep in columns.items()]
    longest = F.greatest(*sizes)
    uneven = F.lit(False)
    for s in sizes:
        uneven = uneven | ((s != longest) & (s != 1))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(uneven).alias("n_uneven"))
