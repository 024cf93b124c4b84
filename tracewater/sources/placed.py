"""Features laid out by place, so that a read within a box opens only the files that reach into it.

Files are filled along a space-filling curve: features are ordered by size
class and then by the Morton code of their box's centre, cut into ranges of
about equal numbers, and each file's own bounds are kept in a small table
beside them. Features larger than a file's share of the whole area lie in files
of their own and do not widen the bounds of all others; smaller ones are one
class.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewater.operators.spatial import BOX
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage

BITS = 16
"""Bits of each axis in a code."""


def morton_code(x: Column, y: Column) -> Column:
    """The bits of two whole numbers below ``2 ** BITS`` in turn, those of ``x`` first."""
    code = F.lit(0).cast("bigint")
    for bit in range(BITS):
        for place, axis in ((2 * bit + 1, x), (2 * bit, y)):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(axis, bit).bitwiseAND(F.lit(1).cast("bigint")), place))
    return code


def _curve(low: Sequence[float], extent: float, files: int) -> list[Column]:
    """Size class and code of a box, for features in a square of side ``extent`` at ``low`` that ``files`` files share."""

    def step(least: str, most: str, start: float) -> Column:
        share = ((F.col(least) + F.col(most)) / 2 - F.lit(start)) / F.lit(extent)
        return F.least(F.lit(2**BITS - 1), F.greatest(F.lit(0), F.floor(share * 2**BITS))).cast("bigint")

    size = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")) / F.lit(extent)
    least = -math.ceil(math.log2(files) / 2)
    level = F.when(size > 2.0**least, F.ceil(F.log2(size))).otherwise(least)
    return [level.alias("level"), morton_code(step("min_x", "max_x", low[0]), step("min_y", "max_y", low[1])).alias("code")]


def _has_box() -> Column:
    """Whether all four bounds are finite numbers."""
    finite = [F.col(c).isNotNull() & (F.abs(F.col(c)) < float("inf")) for c in BOX]
    return finite[0] & finite[1] & finite[2] & finite[3]


def land_by_place(df: DataFrame, folder: str, rows_per_file: int = 100_000) -> str:
    """Write features with box columns (``spatial.with_box``) in order of place; returns ``folder``.

    ``folder/features`` holds the rows, ``folder/boxes`` one row per file: its
    name, bounds and number of rows. A place that many features share is cut
    by their other columns, as far as these differ; the writer caps the rows
    of a file beyond that. Features with a null or infinite bound are kept, in
    the last files. An empty frame gives empty tables. Boxes are written last,
    so a landing that was broken off cannot be read.
    """
    spark = df.sparkSession
    rows = write_stage(df, shared_folder(spark, "places"))
    bounds = rows.where(_has_box()).agg(*[F.min(c).alias(c) for c in BOX[:2]], *[F.max(c).alias(c) for c in BOX[2:]]).first()
    extent = 1.0 if bounds.min_x is None else max(bounds.max_x - bounds.min_x, bounds.max_y - bounds.min_y) or 1.0
    low = (0.0, 0.0) if bounds.min_x is None else (bounds.min_x, bounds.min_y)
    files = max(1, math.ceil(rows.count() / rows_per_file))
    keys = [F.when(_has_box(), key).asc_nulls_last() for key in _curve(low, extent, files)]
    spread = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map" not in f.dataType.simpleString()])
    ordered = rows.repartitionByRange(files, *keys, spread).sortWithinPartitions(*keys)
    ordered.write.option("maxRecordsPerFile", 2 * rows_per_file).parquet(f"{folder}/features")
    landed = spark.read.schema(df.schema).parquet(f"{folder}/features").where(_has_box())
    boxes = landed.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        *[F.min(c).alias(c) for c in BOX[:2]], *[F.max(c).alias(c) for c in BOX[2:]], F.count(F.lit(1)).alias("n_rows")
    )
    write_stage(boxes, f"{folder}/boxes")
    return folder


def _meets(box: Sequence[float]) -> Column:
    x0, y0, x1, y1 = box
    return (F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0)


def features_in_box(spark: SparkSession, folder: str, box: Sequence[float] | DataFrame, most_files: int = 10_000) -> DataFrame:
    """Features whose boxes meet ``box``: ``(x0, y0, x1, y1)``, or the overall box of a frame with box columns.

    Touching counts. Only files whose bounds meet the box are listed and
    opened, and row groups in them are skipped by their own bounds. The driver
    gets the names of those files; where they are more than ``most_files`` the
    whole folder is read instead, with the same result. A frame without boxes
    meets nothing, nor does a feature with a null or infinite bound.
    """
    if isinstance(box, DataFrame):
        found = box.where(_has_box()).agg(F.min("min_x"), F.min("min_y"), F.max("max_x"), F.max("max_y")).first()
        box = tuple(found) if found[0] is not None else (float("inf"), float("inf"), -float("inf"), -float("inf"))
    whole = spark.read.parquet(f"{folder}/features")
    names = [row.name for row in spark.read.parquet(f"{folder}/boxes").where(_meets(box)).select("name").limit(most_files + 1).collect()]
    if not names:
        return whole.where(F.lit(False))
    few = len(names) <= most_files
    rows = spark.read.schema(whole.schema).parquet(*[f"{folder}/features/{name}" for name in names]) if few else whole
    return rows.where(_meets(box) & _has_box())
