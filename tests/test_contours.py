"""Contour rings against a plain tracer."""

import random

from tracewater.operators import contours

SIDES = [(0, 0, 0), (0, 1, 1), (1, 0, 0), (0, 0, 1)]  # bottom, right, top, left as (dy, dx, d)
CORNERS = [(0, 0), (1, 0), (1, 1), (0, 1)]


def py_rings(nodes, level):
    """Directed segments of each cell by following its corners, then rings by walking: start side -> (points, twice the area)."""

    def value(ix, iy):
        return nodes.get((ix, iy), 0.0)

    def place(key):
        iy, ix, d = key
        p, q = value(ix, iy), value(ix + 1, iy) if d == 0 else value(ix, iy + 1)
        share = (level - p) / (q - p)
        return (ix + share, iy) if d == 0 else (ix, iy + share)

    follow = {}
    for ix, iy in {(x - dx, y - dy) for x, y in nodes for dx, dy in CORNERS}:
        v = [value(ix + dx, iy + dy) for dx, dy in CORNERS]
        ins = [a >= level for a in v]
        key = [(iy + dy, ix + dx, d) for dy, dx, d in SIDES]
        for s in range(4):
            if ins[s] and not ins[(s + 1) % 4]:
                ways = [(s + k) % 4 for k in ((1, 2, 3) if sum(v) / 4 >= level else (3, 2, 1))]
                follow[key[s]] = key[next(e for e in ways if not ins[e] and ins[(e + 1) % 4])]
    rings = {}
    while follow:
        start = min(follow)
        walk, at = [start], follow.pop(start)
        while at != start:
            walk.append(at)
            at = follow.pop(at)
        rings[start] = [place(k) for k in walk]
    return rings


def twice_area(points):
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]))


def test_rings_against_a_tracer(spark):
    rnd = random.Random(5)
    plants = {"noise": {(x, y): rnd.random() for x in range(-6, 12) for y in range(14) if rnd.random() < 0.8}}
    plants["ring"] = {(x, y): 1.0 if 4 <= (x - 8) ** 2 + (y - 8) ** 2 <= 40 else 0.1 for x in range(17) for y in range(17)}
    plants["saddles"] = {(x, y): float((x + y) % 2) for x in range(6) for y in range(6)}
    plants[None] = {(0, 0): 0.75}
    rows = [(p, x, y, v) for p, nodes in plants.items() for (x, y), v in nodes.items()]
    grid = spark.createDataFrame([*rows, ("noise", 99, 99, None)], "plant string, ix long, iy long, v double")
    wanted = [(p, b, lv) for p in plants for b, lv in ((50, 0.5), (90, 0.25))] + [("ring", 99, None), ("ring", 98, 0.0), ("none", 1, 0.5)]
    levels = spark.createDataFrame(wanted, "plant string, band int, level double")
    points = contours.ring_points(contours.contour_segments(grid, ["plant"], "v", levels), ["plant"])
    got = {(r.plant, r.band, tuple(r.ring)): r for r in contours.ring_arrays(points, ["plant"]).collect()}
    sums = {(r.plant, r.band, tuple(r.ring)): r for r in contours.ring_summary(points, ["plant"]).collect()}
    want = {(p, b, k): pts for p, b, lv in wanted if p in plants and lv for k, pts in py_rings(plants[p], lv).items()}
    assert set(got) == set(want) == set(sums)
    for key, pts in want.items():
        found = [(p.x, p.y) for p in got[key].points]
        assert found[0] == found[-1] and len(found) == len(pts) + 1 == sums[key].n_points + 1
        assert all(abs(a - b) < 1e-12 for f, w in zip(found, pts) for a, b in zip(f, w))
        assert abs(sums[key].area - twice_area(pts) / 2) < 1e-9 and abs(got[key].area - sums[key].area) < 1e-9
    areas = sorted(r.area for k, r in sums.items() if k[:2] == ("ring", 50))
    assert len(areas) == 2 and areas[0] < 0 < areas[1]  # the hole is kept


def test_steps_origin_and_an_empty_grid(spark):
    grid = spark.createDataFrame([("p", 3, 4, 1.0)], "plant string, ix long, iy long, v double")
    levels = spark.createDataFrame([("p", 1, 0.5)], "plant string, band int, level double")
    segments = contours.contour_segments(grid, ["plant"], "v", levels, (10.0, 100.0), (1000.0, 0.0))
    ring = contours.ring_arrays(contours.ring_points(segments, ["plant"]), ["plant"]).first()
    assert {(p.x, p.y) for p in ring.points} == {(1025.0, 400.0), (1035.0, 400.0), (1030.0, 350.0), (1030.0, 450.0)}
    assert ring.area == 10.0 * 100.0 / 2
    empty = contours.contour_segments(grid.limit(0), ["plant"], "v", levels)
    assert contours.ring_summary(contours.ring_points(empty, ["plant"]), ["plant"]).count() == 0
