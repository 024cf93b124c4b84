"""Kernel density of points per group on a grid, and the bands that hold a share of the points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewater.operators.joins import null_safe_join
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage

def normal_scale_bandwidth(points: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Per-group diagonal bandwidth ``h_x, h_y``: sd * n^(-1/6), the normal-scale rule in two dimensions."""
    scale = F.pow(F.count(F.lit(1)), F.lit(-1.0 / 6.0))
    return points.groupBy(*by).agg(
        (F.stddev_samp(x) * scale).alias("h_x"), (F.stddev_samp(y) * scale).alias("h_y")
    )


def _near(v: Column, h: Column, step: float, origin: float, reach: float) -> Column:
    """Grid lines within reach of ``v``."""
    return F.sequence(
        F.ceil((v - F.lit(reach) * h - F.lit(origin)) / F.lit(step)),
        F.floor((v + F.lit(reach) * h - F.lit(origin)) / F.lit(step)),
    )


def kernel_density(
    points: DataFrame,
    by: Sequence[str],
    x: str,
    y: str,
    step: tuple[float, float],
    bandwidth: tuple[float, float] | DataFrame,
    origin: tuple[float, float] = (0.0, 0.0),
    reach: float = 4.0,
) -> DataFrame:
    """Gaussian density at grid nodes: ``by, ix, iy, density``.

    Points at one spot are counted first, so a crowded address costs one row.
    Each spot then adds its kernel to the nodes within reach, and the sums are
    folded map-side per (group, node).
    ``bandwidth`` is a fixed pair, or a frame with ``by, h_x, h_y``. The kernel
    counts as zero beyond ``reach`` bandwidths. A spot costs
    (2 * reach * h / step)^2 nodes, which stream into the fold.
    """
    spots = points.groupBy(*by, F.col(x).alias("__x"), F.col(y).alias("__y")).agg(F.count(F.lit(1)).alias("__n"))
    # Taken from the spots: their exchange is reused, the points are not read again.
    totals = spots.groupBy(*by).agg(F.sum("__n").alias("__total"))
    if isinstance(bandwidth, tuple):
        spots = spots.withColumns({"h_x": F.lit(float(bandwidth[0])), "h_y": F.lit(float(bandwidth[1]))})
    else:
        spots = spots.join(bandwidth, list(by))
    cells = spots.withColumn("ix", F.explode(_near(F.col("__x"), F.col("h_x"), step[0], origin[0], reach))).withColumn(
        "iy", F.explode(_near(F.col("__y"), F.col("h_y"), step[1], origin[1], reach))
    )
    u = (F.col("ix") * F.lit(step[0]) + F.lit(origin[0]) - F.col("__x")) / F.col("h_x")
    v = (F.col("iy") * F.lit(step[1]) + F.lit(origin[1]) - F.col("__y")) / F.col("h_y")
    kernel = F.exp(-(u * u + v * v) / F.lit(2.0)) / (F.lit(2.0 * math.pi) * F.col("h_x") * F.col("h_y"))
    summed = cells.groupBy(*by, "ix", "iy").agg(F.sum(F.col("__n") * kernel).alias("__s"))
    return summed.join(totals, list(by)).select(
        *by, "ix", "iy", (F.col("__s") / F.col("__total")).alias("density")
    )


def density_bands(
    points: DataFrame,
    density: DataFrame,
    by: Sequence[str],
    x: str,
    y: str,
    step: tuple[float, float],
    shares: Sequence[int] = (10, 25, 50, 75, 90),
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """The smallest share whose region holds each grid node: ``by, ix, iy, density, band``.

    A region of p % is bounded by the (1 - p/100) quantile of the density at
    the points, taken at each point's nearest node and interpolated between
    neighbours. Points are counted per node and per density; the counts are
    sorted over all tasks, and a quantile's place follows from the counts
    before its stretch and those inside it, so no task holds a group. Nodes
    outside the widest region have no band. ``density`` is written out once,
    as sums of doubles need not come out bit for bit the same twice.
    """
    density = write_stage(density, shared_folder(density.sparkSession, "density"))
    levels = _levels_at_points(points, density, by, x, y, step, shares, origin)
    band = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(shares))):
        band = F.when(F.col("density") >= F.col("__levels")[i], p).otherwise(band)
    return density.join(levels, list(by)).select(*by, "ix", "iy", "density", band.alias("band"))


def band_levels(
    points: DataFrame,
    density: DataFrame,
    by: Sequence[str],
    x: str,
    y: str,
    step: tuple[float, float],
    shares: Sequence[int] = (10, 25, 50, 75, 90),
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """``by, band, level``: the density that bounds each region of ``density_bands``, for tracing its outline."""
    levels = _levels_at_points(points, density, by, x, y, step, shares, origin)
    each = F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in shares]).alias("band"), F.col("__levels").alias("level")))
    return levels.select(*by, each.alias("__l")).select(*by, "__l.band", "__l.level")


def _levels_at_points(points, density, by, x, y, step, shares, origin) -> DataFrame:
    """``by, __levels``: the (1 - p/100) quantiles of the density at the points' nearest nodes."""
    nearest = {
        "ix": F.floor((F.col(x) - F.lit(origin[0])) / F.lit(step[0]) + F.lit(0.5)),
        "iy": F.floor((F.col(y) - F.lit(origin[1])) / F.lit(step[1]) + F.lit(0.5)),
    }
    per_node = points.withColumns(nearest).groupBy(*by, "ix", "iy").agg(F.count(F.lit(1)).alias("__n"))
    counts = per_node.join(density, [*by, "ix", "iy"]).groupBy(*by, "density").agg(F.sum("__n").alias("__n"))
    return _quantiles(counts, by, "density", [1.0 - p / 100.0 for p in shares])


def _quantiles(counts: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``by, __levels``: interpolated quantiles of values that stand ``__n`` times each."""
    stretch = F.shiftright(F.monotonically_increasing_id(), 33).alias("__stretch")
    sorted_rows = write_stage(
        counts.sort(*by, value).select("*", stretch), shared_folder(counts.sparkSession, "quantiles")
    )
    earlier = Window.unboundedPreceding
    of_stretch = sorted_rows.groupBy(*by, "__stretch").agg(F.sum("__n").alias("__all"))
    in_group = Window.partitionBy(*by).orderBy("__stretch")
    offsets = of_stretch.select(
        *by,
        "__stretch",
        F.coalesce(F.sum("__all").over(in_group.rowsBetween(earlier, -1)), F.lit(0)).alias("__before"),
        F.sum("__all").over(Window.partitionBy(*by)).alias("__total"),
    )
    inside = Window.partitionBy("__stretch", *by).orderBy(value).rowsBetween(earlier, -1)
    placed = null_safe_join(
        sorted_rows.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))), offsets, [*by, "__stretch"]
    )
    lo = F.col("__before") + F.col("__inside")
    hi = lo + F.col("__n")

    def at(rank: Column) -> Column:
        return F.max(F.when((lo <= rank) & (rank < hi), F.col(value)))

    columns = {}
    for i, q in enumerate(shares):
        place = (F.col("__total") - 1) * F.lit(q)
        columns |= {f"__p{i}": F.max(place), f"__a{i}": at(F.floor(place)), f"__b{i}": at(F.ceil(place))}
    found = placed.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()])

    def level(i: int) -> Column:
        p, a, b = F.col(f"__p{i}"), F.col(f"__a{i}"), F.col(f"__b{i}")
        between = (F.ceil(p) - p) * a + (p - F.floor(p)) * b
        return F.when(F.floor(p) == F.ceil(p), a).when(a == b, a).otherwise(between)

    return found.select(*by, F.array(*[level(i) for i in range(len(shares))]).alias("__levels"))
