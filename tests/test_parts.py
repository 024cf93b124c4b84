"""Shells and holes from flat ring lists, and their round trip through GeoJSON."""

import json
import random

from pyspark.sql import functions as F
from test_spatial_density import CONCAVE, HOLE, box, polygons

from tracewater.operators import parts
from tracewater.sources import readers, sinks


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def brute_parts(rings):
    """Parts by testing a middle of each ring's first edge against all other rings; no ring touches another."""
    around = []
    for i, r in enumerate(rings):
        x, y = ((r[0][k] + r[1][k]) / 2 for k in (0, 1))
        around.append([j for j, o in enumerate(rings) if j != i and inside(o, x, y)])
    out = {i: [i] for i in range(len(rings)) if len(around[i]) % 2 == 0}
    for i, a in enumerate(around):
        if len(a) % 2:
            out[min(a, key=lambda j: abs(area(rings[j])))].append(i)
    turned = lambda i, hole: rings[i][::-1] if (area(rings[i]) > 0) == hole else rings[i]
    return [[sorted(turned(i, k > 0)) for k, i in enumerate(p)] for _, p in sorted(out.items())]


def as_points(ring):
    return [(p["x"], p["y"]) for p in ring]


def moved(ring, dx, dy, by=1.0):
    return [(x * by + dx, y * by + dy) for x, y in ring]


def test_parts_against_brute_force(spark):
    rnd = random.Random(11)
    named = []
    for n in range(15):
        rings = []
        for k in range(rnd.randint(1, 4)):
            dx, dy = 13 * k, 5 * rnd.random()
            rings += [moved(CONCAVE, dx, dy), moved(HOLE, dx, dy), moved(box(5.1, 1, 9, 3)[0], dx, dy)]
            if rnd.random() < 0.7:
                rings.append(moved(HOLE, dx + 1, dy + 1, 0.5))  # an island in the hole
                rings.append(moved(HOLE, dx + 1.75, dy + 1.75, 0.125))  # and a pond on it
        rings = [r[::-1] if rnd.random() < 0.5 else r for r in rings]
        rnd.shuffle(rings)
        named.append((f"p{n}", rings))
    for cell in (0.9, 40.0):
        got = {r.id: r.parts for r in parts.polygon_parts(polygons(spark, named), "id", "rings", cell).collect()}
        assert set(got) == {n for n, _ in named}
        for n, rings in named:
            found = [[as_points(r) for r in p] for p in got[n]]
            assert all(r[0] == r[-1] for p in found for r in p)
            assert all((area(r[:-1]) > 0) == (k == 0) for p in found for k, r in enumerate(p))
            assert [[sorted(r[:-1]) for r in p] for p in found] == brute_parts([[(float(x), float(y)) for x, y in r] for r in rings])


def test_touching_equal_flat_and_missing_rings(spark):
    square, diamond = box(0, 0, 4, 4)[0], [(2, 0), (4, 2), (2, 4), (0, 2)]
    rows = [("touch", [diamond, square]), ("equal", [square, square]), ("flat", [[(0, 0), (4, 0), (2, 0)]]), ("none", [])]
    rows += [("some", [[(0, 0), (4, 0)], square, []]), ("touch", [diamond, square]), (None, [square]), ("beside", [square, box(4, 4, 6, 6)[0]])]
    df = polygons(spark, rows).unionByName(polygons(spark, [("null", [])]).withColumn("rings", F.lit(None).cast("array<array<struct<x: double, y: double>>>")))
    got = {r.id: [len(p) for p in r.parts] for r in parts.polygon_parts(df, "id", "rings", 3.0).collect()}
    assert got == {"touch": [2], "equal": [2], "some": [1], "beside": [1, 1]}
    depth = {(r.id, r.ring): (r.depth, r.around) for r in parts.ring_nesting(df, "id", "rings", 3.0).collect()}
    assert depth[("touch", 0)] == (1, 1) and depth[("equal", 1)] == (1, 0) and depth[("some", 1)] == (0, None)
    assert parts.polygon_parts(df.limit(0), "id", "rings", 1.0).count() == 0


def test_geojson_keeps_parts_and_holes(spark, tmp_path):
    rows = [("a", [HOLE, CONCAVE]), ("b", [CONCAVE, moved(CONCAVE, 20, 0), moved(HOLE, 20, 0), moved(HOLE, 0, 0)]), ("é \"x\"", [box(0, 0, 1, 1)[0]])]
    made = parts.polygon_parts(polygons(spark, rows), "id", "rings", 5.0)
    sinks.write_features(made.withColumn("a.n", F.lit(None).cast("int")), str(tmp_path / "f"))
    back = readers.scan_polygons(spark, str(tmp_path / "f"), {"id": "string", "a.n": "int"}, lines=True, parts=True)
    assert {r.id: r.parts for r in back.collect()} == {r.id: r.parts for r in made.collect()}
    assert all(r.rings == [x for p in r.parts for x in p] for r in back.collect())
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "f")).collect()]
    assert {f["geometry"]["type"] for f in lines} == {"Polygon", "MultiPolygon"} and all(set(f["properties"]) == {"id", "a.n"} for f in lines)
