"""Cell joins against brute force, boundary cases, density against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewater.operators import density, spatial
from tracewater.plans import places

RINGS = "array<array<struct<x: double, y: double>>>"
CONCAVE = [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3)]
SHAPES = [[[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]], [CONCAVE], [CONCAVE, HOLE], [[(20, 20), (22, 20), (21, 23)], CONCAVE]]


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def polygons(spark, named):
    return spark.createDataFrame([(n, [ring(r) for r in rings]) for n, rings in named], f"id string, rings {RINGS}")


def box(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]


def edges(rings):
    for r in rings:
        closed = r if r[0] == r[-1] else [*r, r[0]]
        yield from zip(closed, closed[1:])


def py_covers(rings, x, y):
    odd = False
    for (x1, y1), (x2, y2) in edges(rings):
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_points_against_brute_force(spark):
    rnd = random.Random(7)
    named = []
    for i in range(40):
        dx, dy = rnd.randint(-60, 60), rnd.randint(-60, 60)
        named.append((f"p{i}", [[(x + dx, y + dy) for x, y in r] for r in rnd.choice(SHAPES)]))
    pts = [(i, float(rnd.randint(-70, 80)), float(rnd.randint(-70, 80))) for i in range(1500)]
    points = spark.createDataFrame(pts, "n int, px double, py double")
    expected = {(n, name) for n, x, y in pts for name, rings in named if py_covers(rings, x, y)}
    for cell in (3.0, 25.0, 1000.0):
        got = spatial.points_in_polygons(points, "px", "py", polygons(spark, named), "rings", ["id"], cell)
        found = [(r.n, r.id) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == expected, cell


def test_points_on_broken_numbers_and_copies(spark):
    """Corners and points that are no grid numbers, a star with long edges, and a polygon that stands twice."""
    rnd = random.Random(3)
    star = [[(50 + r * math.cos(t), 50 + r * math.sin(t)) for k in range(14) for t, r in [(k * math.pi / 7, 49.3 if k % 2 else 17.7)]]]
    named = [("star", star), ("twice", box(10.1, 10.3, 30.7, 90.9)), ("twice", box(10.1, 10.3, 30.7, 90.9)), ("empty", [])]
    named += [("holed", [box(0.3, 0.1, 99.7, 99.9)[0], box(20.2, 20.6, 80.4, 80.8)[0]])]
    pts = [(i, rnd.uniform(-5, 105), rnd.uniform(-5, 105)) for i in range(1500)] + [(9999, 10.1, 50.0), (9998, 0.3, 0.1), (9997, None, 3.0)]
    points = spark.createDataFrame(pts, "n int, px double, py double")
    expected = sorted((n, name) for n, x, y in pts if x is not None for name, rings in named if py_covers(rings, x, y))
    for cell in (0.7, 10.1, 33.0):
        got = spatial.points_in_polygons(points, "px", "py", polygons(spark, named), "rings", ["id"], cell)
        assert sorted((r.n, r.id) for r in got.collect()) == expected, cell


def test_pairs_of_points_and_polygons_are_not_joined_again(spark):
    """The pairs may be far more than both inputs: the last join is the one by cell, and the columns to keep are there already."""
    named = [("a", [CONCAVE, HOLE]), ("b", box(0, 0, 0, 0)), ("a", [CONCAVE, HOLE])]
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 1.0, 1.0), (3, math.nan, 0.5), (4, 0.0, 0.0), (5, 9.0, 3.5)], "n int, px double, py double")
    got = spatial.points_in_polygons(points, "px", "py", polygons(spark, named), "rings", ["id"], 16.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__cx" in next(line for line in plan.splitlines() if "Join" in line)
    assert sorted((r.n, r.id) for r in got.collect()) == [(2, "a"), (2, "a"), (4, "a"), (4, "a"), (4, "b"), (5, "a"), (5, "a")]


def test_pairs_of_polygons_are_shuffled_once_and_not_folded_before(spark):
    """Pairs may be far more than polygons: no table of them before the shuffle, no join after it."""
    named = [("a", box(0, 0, 9, 9)), ("a", box(1, 1, 30, 30)), ("a", box(0, 0, 9, 9)), (None, box(9, 9, 12, 12)), ("far", box(90, 90, 91, 91)), ("none", [])]
    other = polygons(spark, [("x", [CONCAVE, HOLE]), ("x", box(8, 8, 10, 10)), ("y", box(12, 12, 12, 12))]).withColumnRenamed("id", "other")
    got = spatial.polygons_meeting(polygons(spark, named), "rings", ["id"], other, "rings", ["other"], 4.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression") < plan.index("Join")
    assert "cx" in next(line for line in plan.splitlines() if "Join" in line)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == 4 and set(found) == {(None, "x"), (None, "y"), ("a", "x"), ("a", "y")}


def test_index_grows_with_cells_and_edges(spark):
    """A polygon of many edges: each edge stands in the cells it passes only, inside cells are marks without edges."""
    n = 4000
    circle = [[(1000 + 900 * math.cos(2 * math.pi * k / n), 1000 + 900 * math.sin(2 * math.pi * k / n)) for k in range(n)]]
    index = spatial.cell_index(polygons(spark, [("big", circle)]), "id", "rings", 20.0)
    size = index.select(F.count("*").alias("cells"), F.sum(F.size("edges")).alias("pieces"), F.count_if(F.size("edges") == 0).alias("marks")).first()
    assert size.marks > 5500 and size.pieces < 2 * n and size.cells < 7000


def py_meet(a, b):
    def side(p, q, r):
        return np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))

    for p, q in edges(a):
        for r, s in edges(b):
            if max(min(p[0], q[0]), min(r[0], s[0])) > min(max(p[0], q[0]), max(r[0], s[0])):
                continue
            if max(min(p[1], q[1]), min(r[1], s[1])) > min(max(p[1], q[1]), max(r[1], s[1])):
                continue
            if side(p, q, r) * side(p, q, s) <= 0 and side(r, s, p) * side(r, s, q) <= 0:
                return True
    return any(py_covers(b, *r[0]) for r in a) or any(py_covers(a, *r[0]) for r in b)


def test_polygons_against_brute_force(spark):
    rnd = random.Random(11)

    def moved(count, tag):
        out = []
        for i in range(count):
            dx, dy, k = rnd.randint(-50, 50), rnd.randint(-50, 50), rnd.choice([1, 1, 2, 0.5])
            out.append((f"{tag}{i}", [[(x * k + dx, y * k + dy) for x, y in r] for r in rnd.choice(SHAPES)]))
        return out

    left, right = moved(60, "a"), moved(60, "b")
    expected = {(a, b) for a, ra in left for b, rb in right if py_meet(ra, rb)}
    assert expected
    for cell in (4.0, 30.0):
        got = spatial.polygons_meeting(
            polygons(spark, left), "rings", ["id"],
            polygons(spark, right).withColumnRenamed("id", "other"), "rings", ["other"], cell,
        )
        assert {(r.id, r.other) for r in got.collect()} == expected, cell


@pytest.mark.parametrize(
    "name, shape, meets",
    [
        ("inside", box(1, 1, 2, 2), True),
        ("outside", box(11, 11, 12, 12), False),
        ("across an edge", box(9, 1, 12, 2), True),
        ("touching a vertex", box(10, 4, 12, 6), True),
        ("touching an edge", box(4, 6, 6, 8), True),
        ("in the notch", box(5, 5, 9, 9), False),
        ("around it", box(-5, -5, 20, 20), True),
    ],
)
def test_touching_counts(spark, name, shape, meets):
    got = spatial.polygons_meeting(
        polygons(spark, [("L", [CONCAVE])]), "rings", ["id"],
        polygons(spark, [(name, shape)]).withColumnRenamed("id", "other"), "rings", ["other"], 5.0,
    )
    assert (got.count() == 1) is meets


def test_area_within_hole_does_not_meet(spark):
    holed = polygons(spark, [("H", [box(0, 0, 10, 10)[0], box(2, 2, 8, 8)[0]])])
    for shape, meets in [(box(3, 3, 7, 7), 0), (box(2, 2, 8, 8), 1), (box(3, 3, 9, 7), 1)]:
        other = polygons(spark, [("o", shape)]).withColumnRenamed("id", "other")
        assert spatial.polygons_meeting(holed, "rings", ["id"], other, "rings", ["other"], 4.0).count() == meets


def test_catchment_postcodes_by_name(spark):
    catchments = polygons(spark, [("Bath Noord", box(0, 0, 10, 10)), ("Dinther", box(8, 0, 20, 10)), ("Elders", box(0, 0, 99, 99))])
    areas = polygons(spark, [("1111AA", box(1, 1, 2, 2)), ("2222BB", box(9, 1, 9.5, 2)), ("3333CC", box(50, 50, 51, 51))])
    got = places.catchment_postcodes(
        catchments.withColumnRenamed("id", "naam"), areas.withColumnRenamed("id", "postcode6"), ["bath", "dinther"], 5.0
    )
    assert {(r.plant, r.postcode6) for r in got.collect()} == {("bath", "1111AA"), ("bath", "2222BB"), ("dinther", "2222BB")}


def test_rings_to_rd(spark):
    df = spark.createDataFrame([([ring([(5.38720621, 52.15517440)])],)], f"rings {RINGS}")
    p = places.rings_to_rd(df).first().rings[0][0]
    assert (round(p.x, 3), round(p.y, 3)) == (155000.0, 463000.0)


def test_density_against_numpy_and_mass(spark):
    rnd = random.Random(3)
    pts = [("a", rnd.gauss(0, 3), rnd.gauss(0, 5)) for _ in range(300)] + [("b", 1.0, 1.0)] * 50
    df = spark.createDataFrame(pts, "plant string, x double, y double")
    step, h = (0.5, 1.0), (1.0, 2.0)
    got = {(r.plant, r.ix, r.iy): r.density for r in density.kernel_density(df, ["plant"], "x", "y", step, h).collect()}
    for plant in "ab":
        own = np.array([(x, y) for p, x, y in pts if p == plant])
        nodes = [(ix, iy) for p, ix, iy in got if p == plant]
        for ix, iy in nodes[:200]:
            u, v = (ix * step[0] - own[:, 0]) / h[0], (iy * step[1] - own[:, 1]) / h[1]
            near = (abs(u) <= 4.0 + 1e-9) & (abs(v) <= 4.0 + 1e-9)
            want = (np.exp(-(u**2 + v**2) / 2) * near).sum() / (2 * math.pi * h[0] * h[1]) / len(own)
            assert got[(plant, ix, iy)] == pytest.approx(want, rel=1e-9)
        mass = sum(d for (p, _, _), d in got.items() if p == plant) * step[0] * step[1]
        assert mass == pytest.approx(1.0, abs=1e-3)


def test_bands_hold_their_share(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([("a", rnd.gauss(0, 3), rnd.gauss(0, 3)) for _ in range(2000)], "plant string, x double, y double")
    step = (0.5, 0.5)
    grid = density.kernel_density(df, ["plant"], "x", "y", step, (0.8, 0.8))
    bands = density.density_bands(df, grid, ["plant"], "x", "y", step)
    node = {"ix": F.floor(F.col("x") / 0.5 + 0.5), "iy": F.floor(F.col("y") / 0.5 + 0.5)}
    per_band = {r.band: r.n for r in df.withColumns(node).join(bands, ["plant", "ix", "iy"]).groupBy("band").agg(F.count("*").alias("n")).collect()}
    held = 0
    for share in (10, 25, 50, 75, 90):
        held += per_band[share]
        assert held / 2000 == pytest.approx(share / 100, abs=0.02)


def test_bandwidth_per_group(spark):
    df = spark.createDataFrame([("a", float(i), float(2 * i)) for i in range(64)], "plant string, x double, y double")
    h = density.normal_scale_bandwidth(df, ["plant"], "x", "y")
    r = h.first()
    assert r.h_x == pytest.approx(np.std(range(64), ddof=1) / 2) and r.h_y == pytest.approx(2 * r.h_x)
    assert density.kernel_density(df, ["plant"], "x", "y", (4.0, 8.0), h).count() > 0


def test_fixed_and_framed_bandwidth_agree_on_a_fine_grid(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0)], "plant string, x double, y double")
    frame = spark.createDataFrame([("a", 30.0, 30.0)], "plant string, h_x double, h_y double")
    fixed = density.kernel_density(df, ["plant"], "x", "y", (1.0, 1.0), (30.0, 30.0))
    framed = density.kernel_density(df, ["plant"], "x", "y", (1.0, 1.0), frame)
    assert fixed.count() == framed.count() == 241 * 241
    assert density.kernel_density(df, ["plant"], "x", "y", (1.0, 1.0), (30.0, 30.0), reach=1.0).count() == 61 * 61


def test_band_levels_equal_quantiles_with_one_crowded_plant(spark):
    rng = np.random.default_rng(3)
    rows = [("crowded", float(x), float(y)) for x, y in rng.integers(0, 40, (900, 2))] + [("small", 1.0, 2.0), ("small", 3.0, 2.0)]
    df = spark.createDataFrame(rows, "plant string, x double, y double")
    counts = df.groupBy("plant", F.col("x").alias("v")).agg(F.count("*").alias("__n"))
    got = {r[0]: r[1] for r in density._quantiles(counts, ["plant"], "v", [0.1, 0.5, 0.9]).collect()}
    for plant in ("crowded", "small"):
        want = np.quantile([r[1] for r in rows if r[0] == plant], [0.1, 0.5, 0.9])
        assert got[plant] == pytest.approx(list(want))


def test_pairs_of_polygons_are_plain_rows_and_crowded_cells_are_dealt(spark, monkeypatch):
    """Many rings start in one cell, kept values repeat, cells are dealt to several tasks: all pairs, each once."""
    monkeypatch.setattr(spatial, "PAIRS_OF_A_TASK", 3)
    many = [box(3 * i, 0, 3 * i + 1, 1)[0] for i in range(70)]
    a = polygons(spark, [("many", many), ("twice", box(0, 50, 1, 51)), ("twice", box(600, 50, 601, 51)), ("alone", box(900, 900, 901, 901))])
    right = [(f"around {i}", box(3 * i - 0.5, -0.5, 3 * i + 1.5, 1.5)) for i in (0, 59, 60, 69)]
    right += [("gap", box(1.25, 0.25, 2.75, 0.75)), ("wide", box(-5, 40, 700, 60)), ("hole", [*box(-9, -9, 300, 9), *box(-1, -1, 211, 2)])]
    found = spatial.polygons_meeting(a, "rings", ["id"], polygons(spark, right).withColumnRenamed("id", "other"), "rings", ["other"], 250.0)
    assert sorted(map(tuple, found.collect())) == [*[("many", f"around {i}") for i in (0, 59, 60, 69)], ("twice", "wide")]
    assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()  # before, loops over edges for each pair
