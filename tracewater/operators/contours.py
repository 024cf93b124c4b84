"""Contour rings of values on grid nodes: marching squares per cell, segments joined to rings over all tasks.

A node is inside a level if its value is at least the level; nodes that are
not given lie outside. Each cell turns its four corners into directed segments
with the inside on the left, between points on the cell's sides. A side that
is crossed ends the segment of one cell and starts the segment of the cell
beside it, so the segments of a level form closed rings, shells run
counterclockwise and holes clockwise, and a ring's signed area tells which it
is. No task holds a ring until its points are asked for as one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage

# Corners counterclockwise from the lower left one, and the four sides that start at them: the corner pair with
# the lower node first, and the side's key as (dx, dy, direction) seen from the cell's lower left node.
_CORNERS = [(0, 0), (1, 0), (1, 1), (0, 1)]
_SIDES = [((0, 1), (0, 0, 0)), ((1, 2), (1, 0, 1)), ((3, 2), (0, 1, 0)), ((0, 3), (0, 0, 1))]


def contour_segments(
    grid: DataFrame,
    by: Sequence[str],
    value: str,
    levels: DataFrame,
    step: tuple[float, float] = (1.0, 1.0),
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """``by, band, a, b, x1, y1, x2, y2``: one directed segment per row, from side ``a`` to side ``b``.

    ``grid`` has one row per node: ``by, ix, iy`` and the value. ``levels`` has
    ``by, band, level`` with levels above zero. A side is named by the struct
    ``(iy, ix, d)`` of its lower node and direction (0 along x, 1 along y). In
    a saddle the mean of the corners decides whether the inside is connected.
    Nodes without a value and levels that are null or not above zero give
    nothing; an empty grid gives no rows.
    """
    corner = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("ix") - dx).alias("cx"), (F.col("iy") - dy).alias("cy"))
                                 for k, (dx, dy) in enumerate(_CORNERS)]))
    at = grid.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"), corner.alias("__c"))
    cells = at.groupBy(*by, F.col("__c.cx").alias("__ix"), F.col("__c.cy").alias("__iy")).agg(
        *[F.coalesce(F.max(F.when(F.col("__c.k") == k, F.col("__v"))), F.lit(0.0)).alias(f"__v{k}") for k in range(4)]
    )
    wanted = levels.filter(F.col("level") > 0).select(*by, "band", F.col("level").cast("double").alias("__level"))
    same = [F.col(f"cells.{c}").eqNullSafe(F.col(f"wanted.{c}")) for c in by]
    top = F.greatest(*[F.col(f"__v{k}") for k in range(4)])
    low = F.least(*[F.col(f"__v{k}") for k in range(4)])
    crossed = cells.alias("cells").join(wanted.alias("wanted"), same)
    crossed = crossed.filter((top >= F.col("__level")) & (low < F.col("__level"))).select(
        *[F.col(f"cells.{c}").alias(c) for c in by], "band", "__level", "__ix", "__iy", *[f"__v{k}" for k in range(4)]
    )
    inside = [F.col(f"__v{k}") >= F.col("__level") for k in range(4)]
    joined = sum((F.col(f"__v{k}") for k in range(1, 4)), F.col("__v0")) / 4 >= F.col("__level")
    leaves = [inside[k] & ~inside[(k + 1) % 4] for k in range(4)]
    enters = [~inside[k] & inside[(k + 1) % 4] for k in range(4)]
    # From a side where the walk around the cell leaves the inside, to the side where it came in: the one before it, or,
    # where a saddle is connected, the one after it. Without a saddle just one side is entered.
    saddle = (leaves[0] & leaves[2]) | (leaves[1] & leaves[3])

    def segment(start: int, end: int) -> Column:
        last = (start + 3) % 4
        after = (start + 1) % 4
        linked = leaves[start] & enters[end]
        if end == last:
            linked &= ~(saddle & joined)
        elif end == after:
            linked &= ~saddle | joined
        return F.when(linked, F.struct(_key(start).alias("a"), _key(end).alias("b"),
                                       *_place(start, step, origin, "1"), *_place(end, step, origin, "2")))

    pairs = [segment(s, e) for s in range(4) for e in range(4) if s != e]
    return crossed.select(*by, "band", F.explode(F.filter(F.array(*pairs), lambda s: s.isNotNull())).alias("__s")).select(
        *by, "band", "__s.*"
    )


def _key(side: int) -> Column:
    dx, dy, d = _SIDES[side][1]
    return F.struct(
        (F.col("__iy") + dy).cast("long").alias("iy"), (F.col("__ix") + dx).cast("long").alias("ix"), F.lit(d).alias("d")
    )


def _place(side: int, step: tuple[float, float], origin: tuple[float, float], tag: str) -> list[Column]:
    """Where the level crosses a side, seen from its lower node, so both cells of the side get the same doubles."""
    (p, q), (dx, dy, d) = _SIDES[side]
    share = (F.col("__level") - F.col(f"__v{p}")) / (F.col(f"__v{q}") - F.col(f"__v{p}"))
    x, y = (F.col("__ix") + dx).cast("double"), (F.col("__iy") + dy).cast("double")
    x, y = (x + share, y) if d == 0 else (x, y + share)
    return [(F.lit(origin[0]) + x * F.lit(step[0])).alias(f"x{tag}"), (F.lit(origin[1]) + y * F.lit(step[1])).alias(f"y{tag}")]


def ring_points(segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, band, ring, place, x1, y1, x2, y2``: each segment with its ring and its place in it, from 0.

    Every segment points at the one that starts where it ends. In round k it
    knows the least side among the 2^k segments from it on, and how far that
    is; joined with the segment 2^k further it knows 2^(k+1) of them. When a
    round changes nothing, the windows of each ring agree on its least side,
    which names the ring and starts it. That takes as many rounds as the
    longest ring has binary digits, each one join on a side's key, written to
    the shared folder. ``ring`` is the struct of that side.
    """
    spark = segments.sparkSession
    segments = write_stage(segments, shared_folder(spark, "segments"))
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate([*by, "band"])])
    state = segments.select(
        group.alias("g"), "a", F.col("b").alias("to"), F.col("a").alias("ring"), F.lit(0).cast("long").alias("ahead"),
        F.lit(True).alias("moved"),
    )
    width = 1
    while True:
        far = state.select("g", F.col("a").alias("to"), F.col("to").alias("to2"), F.col("ring").alias("ring2"), F.col("ahead").alias("ahead2"))
        less = F.col("ring2") < F.col("ring")
        state = write_stage(
            state.join(far, ["g", "to"]).select(
                "g", "a", F.col("to2").alias("to"), F.when(less, F.col("ring2")).otherwise(F.col("ring")).alias("ring"),
                F.when(less, F.col("ahead2") + width).otherwise(F.col("ahead")).alias("ahead"), less.alias("moved"),
            ),
            shared_folder(spark, "rings"),
        )
        if not state.filter("moved").limit(1).count():
            break
        width *= 2
    sizes = state.groupBy("g", "ring").agg(F.count(F.lit(1)).alias("__n"))
    placed = state.join(sizes, ["g", "ring"]).select(
        "g", "a", "ring", ((F.col("__n") - F.col("ahead")) % F.col("__n")).alias("place")
    )
    return segments.withColumn("g", group).join(placed, ["g", "a"]).select(
        *by, "band", "ring", "place", "x1", "y1", "x2", "y2"
    )


def ring_summary(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, band, ring, n_points, area``: area is positive for shells, negative for holes.

    The signed sum of a ring's segments is folded before the shuffle.
    """
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return points.groupBy(*by, "band", "ring").agg(
        F.count(F.lit(1)).alias("n_points"), (F.sum(cross) / 2).alias("area")
    )


def ring_arrays(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, band, ring, area, points``: each ring closed, as ``array<struct<x,y>>`` in order from its least side."""
    place = F.struct("place", F.col("x1").alias("x"), F.col("y1").alias("y"))
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    sorted_points = F.expr("transform(array_sort(__p), p -> named_struct('x', p.x, 'y', p.y))")
    return points.groupBy(*by, "band", "ring").agg(F.collect_list(place).alias("__p"), (F.sum(cross) / 2).alias("area")).select(
        *by, "band", "ring", "area", F.concat(sorted_points, F.slice(sorted_points, 1, 1)).alias("points")
    )
