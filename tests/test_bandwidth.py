"""Plug-in bandwidth matrices and the density with a full matrix, against direct double sums."""

import math
import os

import numpy as np
import pytest

from tracewater.bindings import QUERIES
from tracewater.operators import bandwidth, density


def partial(order, k, u, v, g):
    """A derivative of the round normal density, k times along v, by numpy's own Hermite series."""
    he = np.polynomial.hermite_e.HermiteE
    one = he.basis(order - k)(u / g) * he.basis(k)(v / g) / g**order
    return one * np.exp(-(u * u + v * v) / (2 * g * g)) / (2 * math.pi * g * g)


def direct(points):
    """The rule by sums over all pairs of points, its last step by a fine search over shapes."""
    n = len(points)
    cov = np.cov(points.T)
    values, vectors = np.linalg.eigh(cov)
    root = vectors @ np.diag(np.sqrt(values)) @ vectors.T
    w = points @ np.linalg.inv(root)
    u, v = (w[:, None, i] - w[None, :, i] for i in (0, 1))
    above = [partial(8, k, 0.0, 0.0, math.sqrt(2)) for k in range(9)]
    for order in (6, 4):
        a = np.array([partial(order, k, 0.0, 0.0, 1.0) for k in range(order + 1)])
        b = np.array([above[k] + above[k + 2] for k in range(order + 1)])
        ways = np.array([math.comb(order, k) for k in range(order + 1)])
        g = np.exp(np.linspace(-4, 2, 400001))  # least summed squared bias, by search
        bias = sum(c * (x / (n * g ** (order + 2)) + g * g * y / 2) ** 2 for c, x, y in zip(ways, a, b))
        g = g[bias.argmin()]
        above = [partial(order, k, u, v, g).sum() / n**2 for k in range(order + 1)]

    def error(h):
        hxx, hxy, hyy = h
        m = [hxx * hxx, 4 * hxx * hxy, 2 * hxx * hyy + 4 * hxy * hxy, 4 * hxy * hyy, hyy * hyy]
        return 1 / (4 * math.pi * n * math.sqrt(hxx * hyy - hxy * hxy)) + sum(x * y for x, y in zip(m, above)) / 4

    h, width = np.array([1.0, 0.0, 1.0]) * n ** (-1 / 3), 0.2
    while width > 1e-7:  # the best of the neighbours, closer and closer
        steps = [h + width * h[0] * np.array(d) for d in np.ndindex(3, 3, 3) for d in [np.array(d) - 1]]
        best = min((s for s in steps if s[0] > 0 and s[0] * s[2] > s[1] ** 2), key=error)
        h, width = (best, width) if error(best) < error(h) else (h, width / 2)
    return root @ np.array([[h[0], h[1]], [h[1], h[2]]]) @ root


def clouds():
    rng = np.random.default_rng(4)
    slanted = rng.normal(size=(150, 2)) @ np.array([[3.0, 2.0], [0.0, 0.5]])
    halves = np.concatenate([rng.normal(size=(80, 2)), rng.normal(size=(60, 2)) * [0.5, 2.0] + [6.0, 3.0]])
    return {"slanted": slanted + 500000.0, "halves": halves, None: rng.gamma(2.0, size=(120, 2))}


def frame(spark, named):
    rows = [(p, float(a), float(b)) for p, points in named.items() for a, b in points]
    return spark.createDataFrame(rows, "plant string, x double, y double")


def test_plug_in_against_double_sums(spark):
    named = clouds()
    line = {"line": np.array([[i, 2.0 * i] for i in range(20)]), "spot": np.ones((5, 2)), "one": np.ones((1, 2))}
    df = frame(spark, named | line).union(spark.createDataFrame([("halves", None, 1.0)], "plant string, x double, y double"))
    got = {r.plant: r for r in bandwidth.plug_in_bandwidth(df, ["plant"], "x", "y", nodes=401).collect()}
    assert set(got) == set(named) | set(line) and all(got[k].h_xx is None for k in line)
    for plant, points in named.items():
        want = direct(points)
        found = np.array([[got[plant].h_xx, got[plant].h_xy], [got[plant].h_xy, got[plant].h_yy]])
        assert np.abs(found - want).max() < 0.01 * np.abs(want).max(), (plant, found, want)
    coarse = {r.plant: r for r in bandwidth.plug_in_bandwidth(df, ["plant"], "x", "y").collect()}
    assert coarse["halves"].h_xx == pytest.approx(got["halves"].h_xx, rel=0.02)
    assert bandwidth.plug_in_bandwidth(df.limit(0), ["plant"], "x", "y").count() == 0


def test_matrix_density_against_double_sums(spark):
    points = clouds()["halves"]
    df = frame(spark, {"p": points, None: points[:20], "none": points[:3]})
    h = np.array([[0.8, 0.5], [0.5, 0.6]])
    widths = spark.createDataFrame([("p", 0.8, 0.5, 0.6), (None, 0.8, 0.5, 0.6), ("none", None, None, None)], "plant string, h_xx double, h_xy double, h_yy double")
    found = bandwidth.matrix_density(df, ["plant"], "x", "y", (0.5, 0.25), widths, (0.1, 0.2)).collect()
    got = {(r.plant, r.ix, r.iy): r.density for r in found}
    assert len(got) == len(found) and {k[0] for k in got} == {"p", None}
    for plant, some in (("p", points), (None, points[:20])):
        for ix in range(-12, 24):
            for iy in range(-24, 60):
                d = np.array([ix * 0.5 + 0.1, iy * 0.25 + 0.2]) - some
                q = np.einsum("ni,ij,nj->n", d, np.linalg.inv(h), d)
                want = (np.exp(-q / 2) * (q <= 16)).sum() / (2 * math.pi * math.sqrt(np.linalg.det(h)) * len(some))
                assert got.get((plant, ix, iy), 0.0) == pytest.approx(want, abs=1e-12)


def test_matrix_density_without_a_turn(spark):
    df = frame(spark, {"p": clouds()["halves"]})
    widths = spark.createDataFrame([("p", 0.49, 0.0, 1.44)], "plant string, h_xx double, h_xy double, h_yy double")
    turned = {(r.ix, r.iy): r.density for r in bandwidth.matrix_density(df, ["plant"], "x", "y", (1.0, 1.0), widths).collect()}
    plain = density.kernel_density(df, ["plant"], "x", "y", (1.0, 1.0), (0.7, 1.2)).collect()
    assert all(abs(r.density - turned.get((r.ix, r.iy), 0.0)) < 1e-4 for r in plain)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_against_double_sums(spark):
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet").selectExpr("event_type", "cast(hour(ts) as double) x", "value y").collect()
    got = {(r.event_type, r.ix, r.iy): r.density for r in QUERIES["kde_plug_in"](spark, folder).collect()}
    for kind in {r.event_type for r in events}:
        points = np.array([[r.x, r.y] for r in events if r.event_type == kind])
        h = direct(points)
        ix = np.arange(-10, 35)
        iy = np.arange(int(points[:, 1].min() // 20) - 5, int(points[:, 1].max() // 20) + 6)
        d = np.stack(np.meshgrid(ix, iy * 20.0, indexing="ij"), -1)[:, :, None, :] - points
        q = np.einsum("abni,ij,abnj->abn", d, np.linalg.inv(h), d)
        want = (np.exp(-q / 2) * (q <= 16)).sum(-1) / (2 * math.pi * math.sqrt(np.linalg.det(h)) * len(points))
        found = np.array([[got.get((kind, a, b), 0.0) for b in iy] for a in ix])
        assert np.abs(found - want).max() < 0.02 * want.max()
        assert sum(v for k, v in got.items() if k[0] == kind) == pytest.approx(found.sum())
