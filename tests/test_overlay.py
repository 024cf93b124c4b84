"""Common areas against exact formulas and brute force over slabs."""

import random

import pytest
from pyspark.sql import functions as F

from test_spatial_density import CONCAVE, HOLE, box, edges, polygons
from tracewater.operators import overlay, spatial


def slab_area(*shapes):
    """Area inside all shapes: exact sums over the slabs between all heights where edges start or meet."""
    sides = [list(edges(s)) for s in shapes]
    every = [e for side in sides for e in side]
    ys = {p[1] for e in every for p in e}
    for (ax, ay), (bx, by) in every:
        for (cx, cy), (dx, dy) in every:
            d = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if d:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / d
                if 0 <= t <= 1:
                    ys.add(ay + t * (by - ay))
    ys, total = sorted(ys), 0.0
    for lo, hi in zip(ys, ys[1:]):
        m = (lo + hi) / 2
        walk = sorted(
            ((x2 - x1) * (m - y1) / (y2 - y1) + x1, k)
            for k, side in enumerate(sides) for (x1, y1), (x2, y2) in side if (y1 > m) != (y2 > m)
        )
        on = [False] * len(sides)
        for (x, k), (after, _) in zip(walk, walk[1:]):
            on[k] = not on[k]
            total += (after - x) * (hi - lo) if all(on) else 0
    return total


def moved(shape, dx, dy, by=1.0):
    return [[(x * by + dx, y * by + dy) for x, y in r] for r in shape]


STAR = [[(0, 0), (4, 3), (9, 1), (6, 5), (8, 10), (4, 7), (-1, 9), (1, 5)], [(3, 4), (5, 4), (4, 6)]]


@pytest.mark.parametrize("cell", [1.3, 50.0])
def test_overlaps_against_slabs(spark, cell):
    rnd = random.Random(3)
    kinds = [[CONCAVE, HOLE], STAR, box(0, 0, 5, 2), [[(0, 0), (7, 1), (2, 6)]]]
    left = [(f"a{i}", moved(kinds[i % 4], rnd.uniform(-9, 9), rnd.uniform(-9, 9), rnd.uniform(0.5, 2))) for i in range(12)]
    right = [(f"b{i}", moved(kinds[i % 4], rnd.randint(-9, 9), rnd.randint(-9, 9))) for i in range(12)]
    right += [("same", left[1][1]), ("shared side", box(0, 0, 5, 2))]
    a, b = polygons(spark, left), polygons(spark, right).withColumnRenamed("id", "other")
    got = {(r.id, r.other): (r.area, r.share) for r in overlay.polygon_overlaps(a, "rings", ["id"], b, "rings", ["other"], cell, least=1e-9).collect()}
    for n, x in left:
        own = slab_area(x)
        for m, y in right:
            area = slab_area(x, y)
            assert got.get((n, m), (0, 0)) == pytest.approx((area, area / own), abs=1e-7), (n, m)
    pieces = overlay.clipped_pieces(a, "rings", ["id"], b, "rings", ["other"], cell).groupBy("id", "other").agg(F.sum("area").alias("area"))
    assert {(r.id, r.other): r.area for r in pieces.where("area > 1e-9").collect()} == pytest.approx({k: v[0] for k, v in got.items()})
    alone = {r.id: r.area for r in overlay.polygon_areas(a, "rings", ["id"], cell).collect()}
    assert alone == pytest.approx({n: slab_area(x) for n, x in left})


def test_touching_shared_sides_and_repeats(spark):
    a = polygons(spark, [("a", box(0, 0, 4, 4)), ("a", box(0, 0, 4, 4)), ("none", []), ("flat", [[(0, 0), (4, 0), (2, 0)]])])
    right = [("beside", box(4, 0, 8, 4)), ("corner", box(4, 4, 8, 8)), ("within", box(0, 0, 4, 2)), ("equal", box(0, 0, 4, 4))]
    right += [("around", [box(-1, -1, 5, 5)[0], box(0, 0, 4, 4)[0]]), ("turned", [[(0, 0), (0, 4), (4, 4), (4, 0)]])]
    b = polygons(spark, right).withColumnRenamed("id", "other")
    for cell in (1.0, 3.0, 40.0):
        got = {(r.id, r.other): (r.area, r.share) for r in overlay.polygon_overlaps(a, "rings", ["id"], b, "rings", ["other"], cell).collect()}
        assert got == {("a", "within"): (8.0, 0.5), ("a", "equal"): (16.0, 1.0), ("a", "turned"): (16.0, 1.0)}
    assert overlay.polygon_overlaps(a.limit(0), "rings", ["id"], b, "rings", ["other"], 1.0).count() == 0
    nulls = a.withColumn("rings", F.lit(None).cast(a.schema["rings"].dataType))
    assert overlay.polygon_overlaps(nulls, "rings", ["id"], b, "rings", ["other"], 1.0).count() == 0


def test_pieces_lie_in_both(spark):
    a, b = polygons(spark, [("a", STAR)]), polygons(spark, [("b", moved([CONCAVE, HOLE], 1, 1))]).withColumnRenamed("id", "other")
    pieces = overlay.clipped_pieces(a, "rings", ["id"], b, "rings", ["other"], 2.0)
    middle = pieces.select(
        F.monotonically_increasing_id().alias("n"), *[(sum((F.col("ring")[i][v] for i in range(1, 4)), F.col("ring")[0][v]) / 4).alias(v) for v in "xy"]
    )
    n = middle.count()
    assert n > 5 and spatial.points_in_polygons(middle, "x", "y", a, "rings", ["id"], 3.0).count() == n
    assert spatial.points_in_polygons(middle, "x", "y", b, "rings", ["other"], 3.0).count() == n


def test_only_edges_in_the_common_box_cut_slabs(spark):
    """A polygon with many corners elsewhere in the cell is not cut at them; boxes that miss each other in a cell give nothing."""
    comb = [(0.0, 0.0), (0.0, 1.0), (30.0, 1.0), (30.0, 0.6), (28.0, 0.5), (30.0, 0.4), (30.0, 0.0), (0.0, 0.0)]
    square = [(17.0, 0.25), (19.0, 0.25), (19.0, 0.75), (17.0, 0.75), (17.0, 0.25)]
    apart = [(1.0, -5.0), (2.0, -5.0), (2.0, -4.0), (1.0, -4.0), (1.0, -5.0)]
    touching = [(1.0, -1.0), (2.0, -1.0), (2.0, 0.0), (1.0, 0.0), (1.0, -1.0)]
    schema = "name string, rings array<array<struct<x: double, y: double>>>"
    a = spark.createDataFrame([("square", [square]), ("apart", [apart]), ("touching", [touching])], schema)
    b = spark.createDataFrame([("comb", [comb])], schema.replace("name", "other"))
    got = overlay.polygon_overlaps(a, "rings", ["name"], b, "rings", ["other"], 100.0).collect()
    assert [(r.name, r.other, r.area, r.share) for r in got] == [("square", "comb", 1.0, 1.0)]
    pieces = overlay.clipped_pieces(a, "rings", ["name"], b, "rings", ["other"], 100.0).collect()
    assert len(pieces) == 1  # before, a slab for each corner of the notch at the other end
