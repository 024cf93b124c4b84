"""Polygon parts: which rings are shells, which are holes, and which shell a hole belongs to.

A polygon's rings may come in any order and direction, as contours and flat
ring lists do. A ring's depth is the number of the polygon's other rings around
it: even depths are shells, odd ones are holes of the smallest ring around
them, and an island in a hole is a part of its own. Rings are laid on the cell
index one by one, so finding the rings around a ring's points is an equi join
on polygon and cell, however many rings a polygon has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.operators.spatial import _found, cell_index


def signed_area(ring: Column) -> Column:
    """Above zero for a counterclockwise ring, open or closed; taken from its first point, so far-off rings lose no digits."""
    first = ring[0]
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    turns = F.zip_with(ring, after, lambda p, q: (p.x - first.x) * (q.y - first.y) - (q.x - first.x) * (p.y - first.y))
    return F.aggregate(turns, F.lit(0.0), lambda total, t: total + t) / 2


def ring_nesting(polygons: DataFrame, key: str, rings: str, cell: float) -> DataFrame:
    """``key, ring, points, area, depth, around``: a row per ring; ``around`` is the smallest ring about it.

    ``ring`` is its place in the list, ``points`` and ``area`` (signed) are as
    given. A ring is around another if it covers more than half of the other's
    corners and edge middles, so rings that touch in single points nest well;
    of equal rings the earlier one counts as around the later. Rings without
    an area and null rings are left out. Rows with one key must be copies of
    one polygon, and count once; rows without key are left out.
    """
    listed = polygons.filter(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.posexplode(rings).alias("ring", "points"))
    every = listed.dropDuplicates(["__key", "ring"]).withColumn("area", signed_area(F.col("points"))).filter("area <> 0")
    named = every.withColumn("__id", F.struct("__key", "ring"))
    index = cell_index(named.withColumn("__rings", F.array("points")), "__id", "__rings", cell)
    after = F.concat(F.slice("points", 2, F.size("points") - 1), F.slice("points", 1, 1))
    middles = F.zip_with("points", after, lambda p, q: F.struct(((p.x + q.x) / 2).alias("x"), ((p.y + q.y) / 2).alias("y")))
    tests = named.select(F.col("__key").alias("__own"), F.col("ring").alias("__inner"), F.explode(F.concat("points", middles)).alias("p"))
    tests = tests.select("__own", "__inner", "p.x", "p.y")
    met = _found(tests, "x", "y", index, cell, also=F.col("__own") == F.col("__id.__key")).filter("__inner <> __id.ring")
    covered = met.groupBy("__own", "__inner", F.col("__id.ring").alias("__outer")).agg(F.count(F.lit(1)).alias("n"))
    size = F.abs("area")
    inner = every.select(F.col("__key").alias("__own"), F.col("ring").alias("__inner"), size.alias("__size"), (2 * F.size("points")).alias("__of"))
    outer = every.select(F.col("__key").alias("__own"), F.col("ring").alias("__outer"), size.alias("__outer_size"))
    larger = F.struct(F.col("__outer_size"), -F.col("__outer")) > F.struct(F.col("__size"), -F.col("__inner"))
    held = covered.join(inner, ["__own", "__inner"]).join(outer, ["__own", "__outer"]).filter(F.col("n") * 2 > F.col("__of")).filter(larger)
    nested = held.groupBy(F.col("__own").alias("__key"), F.col("__inner").alias("ring")).agg(
        F.count(F.lit(1)).alias("depth"), F.min(F.struct("__outer_size", -F.col("__outer"), F.col("__outer").alias("at"))).alias("least")
    )
    return every.join(nested, ["__key", "ring"], "left").select(
        F.col("__key").alias(key), "ring", "points", "area", F.coalesce("depth", F.lit(0)).alias("depth"), F.col("least.at").alias("around")
    )


def polygon_parts(polygons: DataFrame, key: str, rings: str, cell: float) -> DataFrame:
    """``key, parts``: each polygon as a list of parts, each its shell first and then its holes.

    Shells run counterclockwise, holes clockwise, all are closed; parts and
    holes keep the order of the list. A polygon without a ring of some area
    has no row.
    """
    nested = ring_nesting(polygons, key, rings, cell)
    is_hole = F.col("depth") % 2 == 1
    closed = F.when(F.element_at("points", 1) == F.element_at("points", -1), F.col("points")).otherwise(F.concat("points", F.slice("points", 1, 1)))
    turned = nested.withColumn("points", closed).withColumn(
        "points", F.when((F.col("area") > 0) == is_hole, F.reverse("points")).otherwise(F.col("points"))
    )
    placed = turned.select(key, F.when(is_hole, F.col("around")).otherwise(F.col("ring")).alias("shell"), is_hole.alias("hole"), "ring", "points")
    part = F.transform(F.array_sort(F.collect_list(F.struct("hole", "ring", "points"))), lambda r: r.points)
    each = placed.groupBy(key, "shell").agg(part.alias("part"))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("shell", "part"))), lambda p: p.part).alias("parts"))


def geometry_text(parts: Column) -> Column:
    """Parts as a GeoJSON polygon, or a multipolygon if there are several."""
    points = F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(p.x, p.y))))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), points[0].alias("coordinates")))
    several = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), points.alias("coordinates")))
    return F.when(F.size(parts) == 1, one).when(F.size(parts) > 1, several)
