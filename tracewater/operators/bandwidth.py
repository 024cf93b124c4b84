"""Data-driven bandwidth matrices for kernel density in two dimensions, and the density with a full matrix.

The two-stage plug-in rule with one pilot bandwidth per stage (Wand and Jones 1994; Duong and Hazelton 2003). Points
are made round and of unit spread by their own covariance, and shared out over the nodes of a grid that spans them.
From sums over pairs of nodes the rule estimates the sixth and then the fourth derivatives of the density, and takes
the matrix with the least asymptotic error. Spark counts moments and nodes; what one group hands to its numeric step
are at most ``NODES`` squared counts, however many points it has, and the pair sums follow from one Fourier transform.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.operators.density import _near
from tracewater.operators.joins import null_safe_join

# The numeric step travels to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = 151  # grid nodes per axis
MATRIX = ["h_xx", "h_xy", "h_yy"]


def plug_in_bandwidth(points: DataFrame, by: Sequence[str], x: str, y: str, nodes: int = NODES) -> DataFrame:
    """``by, h_xx, h_xy, h_yy``: the plug-in bandwidth matrix (variances, not deviations) of each group.

    Points without both coordinates do not count. A group whose points lie on
    one line or in one spot has no matrix and gives null. Where the estimated
    error has no least value, the normal-scale matrix n^(-1/3) * covariance
    is taken.
    """
    by = list(by)
    placed = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    spots = placed.groupBy(*by, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).agg(
        F.count(F.lit(1)).cast("double").alias("__n")
    )
    # Moments about a point of the group, as coordinates may be large beside their spread.
    pinned = null_safe_join(spots, spots.groupBy(*by).agg(F.min("__x").alias("__px"), F.min("__y").alias("__py")), by, "inner")
    dx, dy, n = F.col("__x") - F.col("__px"), F.col("__y") - F.col("__py"), F.col("__n")
    sums = {"n": n, "sx": n * dx, "sy": n * dy, "sxx": n * dx * dx, "sxy": n * dx * dy, "syy": n * dy * dy}
    moments = pinned.groupBy(*by).agg(
        F.max("__px").alias("__px"), F.max("__py").alias("__py"), *[F.sum(c).alias(f"__{k}") for k, c in sums.items()]
    )

    def covariance(a: str, b: str) -> Column:
        return (F.col(f"__s{a}{b}") - F.col(f"__s{a}") * F.col(f"__s{b}") / F.col("__n")) / (F.col("__n") - 1)

    root, trace = F.sqrt(F.col("__det")), F.sqrt(F.col("__vxx") + F.col("__vyy") + 2 * F.sqrt(F.col("__det")))
    spread = (
        moments.filter("__n > 1")
        .withColumns({"__vxx": covariance("x", "x"), "__vxy": covariance("x", "y"), "__vyy": covariance("y", "y")})
        .withColumn("__det", F.col("__vxx") * F.col("__vyy") - F.col("__vxy") * F.col("__vxy"))
        .filter(F.col("__det") > 1e-12 * F.col("__vxx") * F.col("__vyy"))
        # The symmetric root of the covariance; its inverse makes the points round.
        .withColumns({"__rxx": (F.col("__vxx") + root) / trace, "__rxy": F.col("__vxy") / trace, "__ryy": (F.col("__vyy") + root) / trace})
    ).select(*by, "__px", "__py", F.col("__n").alias("__all"), "__rxx", "__rxy", "__ryy")
    rdet = F.col("__rxx") * F.col("__ryy") - F.col("__rxy") * F.col("__rxy")
    rx, ry = F.col("__x") - F.col("__px"), F.col("__y") - F.col("__py")
    round_points = null_safe_join(spots, spread, by, "inner").select(
        *by, "__n", "__all", "__rxx", "__rxy", "__ryy",
        ((F.col("__ryy") * rx - F.col("__rxy") * ry) / rdet).alias("__u"),
        ((F.col("__rxx") * ry - F.col("__rxy") * rx) / rdet).alias("__v"),
    )
    extent = round_points.groupBy(*by).agg(
        F.min("__u").alias("__u0"), F.min("__v").alias("__v0"),
        ((F.max("__u") - F.min("__u")) / (nodes - 1)).alias("__du"), ((F.max("__v") - F.min("__v")) / (nodes - 1)).alias("__dv"),
    )
    # Each point is shared between the four nodes around it, by how near it is to each.
    at_u, at_v = (F.col("__u") - F.col("__u0")) / F.col("__du"), (F.col("__v") - F.col("__v0")) / F.col("__dv")
    base = null_safe_join(round_points, extent, by, "inner").withColumns(
        {"__i": F.least(F.floor(at_u), F.lit(nodes - 2)), "__j": F.least(F.floor(at_v), F.lit(nodes - 2))}
    )
    fu, fv = at_u - F.col("__i"), at_v - F.col("__j")
    corners = [((1 - fu) * (1 - fv), 0, 0), (fu * (1 - fv), 1, 0), ((1 - fu) * fv, 0, 1), (fu * fv, 1, 1)]
    shared = F.explode(F.array(*[F.struct((F.col("__i") + a).alias("i"), (F.col("__j") + b).alias("j"), (w * F.col("__n")).alias("w"))
                                 for w, a, b in corners]))
    kept = ["__all", "__rxx", "__rxy", "__ryy", "__du", "__dv"]
    counts = base.select(*by, *kept, shared.alias("__c")).groupBy(*by, "__c.i", "__c.j").agg(
        F.sum("__c.w").alias("__w"), *[F.max(c).alias(c) for c in kept]
    )
    schema = T.StructType([*[counts.schema[c] for c in by], *[T.StructField(c, T.DoubleType()) for c in MATRIX]])

    def numeric(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        grid = np.zeros((nodes, nodes))
        grid[group["i"], group["j"]] = group["__w"]
        h = _plug_in(grid, float(first["__all"]), float(first["__du"]), float(first["__dv"]))
        r = np.array([[first["__rxx"], first["__rxy"]], [first["__rxy"], first["__ryy"]]], dtype=float)
        h = r @ h @ r
        return pd.DataFrame({**{c: group[c].iloc[:1] for c in by}, "h_xx": h[0, 0], "h_xy": h[0, 1], "h_yy": h[1, 1]})

    found = counts.groupBy(*by).applyInPandas(numeric, schema)
    return null_safe_join(moments.select(*by), found, by, "left")


def matrix_density(
    points: DataFrame,
    by: Sequence[str],
    x: str,
    y: str,
    step: tuple[float, float],
    bandwidth: DataFrame,
    origin: tuple[float, float] = (0.0, 0.0),
    reach: float = 4.0,
) -> DataFrame:
    """Gaussian density with a full bandwidth matrix per group: ``by, ix, iy, density``.

    ``bandwidth`` has ``by, h_xx, h_xy, h_yy``; groups without a matrix give no
    rows. The kernel is an ellipse that may be turned; it counts as zero where
    it is further than ``reach`` deviations from its point, so a spot costs the
    nodes of that ellipse. Points at one spot are counted first.
    """
    by = list(by)
    spots = points.groupBy(*by, F.col(x).alias("__x"), F.col(y).alias("__y")).agg(F.count(F.lit(1)).alias("__n"))
    totals = spots.groupBy(*by).agg(F.sum("__n").alias("__total"))
    known = bandwidth.filter((F.col("h_xx") > 0) & (F.col("h_xx") * F.col("h_yy") > F.col("h_xy") * F.col("h_xy")))
    det = F.col("h_xx") * F.col("h_yy") - F.col("h_xy") * F.col("h_xy")
    dx = F.col("ix") * F.lit(step[0]) + F.lit(origin[0]) - F.col("__x")
    dy = F.col("iy") * F.lit(step[1]) + F.lit(origin[1]) - F.col("__y")
    # Along a grid line the ellipse is a stretch about a centre that moves with the line.
    centre = F.col("__y") + dx * F.col("h_xy") / F.col("h_xx")
    half = F.sqrt(F.greatest(det / F.col("h_xx") * (reach * reach - dx * dx / F.col("h_xx")), F.lit(0.0)))
    first = F.ceil((centre - half - F.lit(origin[1])) / F.lit(step[1]))
    last = F.floor((centre + half - F.lit(origin[1])) / F.lit(step[1]))
    lines = null_safe_join(spots, known, by, "inner").withColumn(
        "ix", F.explode(_near(F.col("__x"), F.sqrt(F.col("h_xx")), step[0], origin[0], reach))
    )
    nodes = lines.withColumns({"__f": first, "__t": last}).filter("__f <= __t").withColumn("iy", F.explode(F.sequence("__f", "__t")))
    far = (dx * dx * F.col("h_yy") - 2 * dx * dy * F.col("h_xy") + dy * dy * F.col("h_xx")) / det
    kernel = F.exp(-far / 2) / (F.lit(2.0 * math.pi) * F.sqrt(det))
    summed = nodes.groupBy(*by, "ix", "iy").agg(F.sum(F.col("__n") * kernel).alias("__s"))
    return null_safe_join(summed, totals, by, "inner").select(*by, "ix", "iy", (F.col("__s") / F.col("__total")).alias("density"))


def _hermite(order: int, t):
    """Probabilists' Hermite polynomial: the derivative of the normal density is (-1)^order * He(t) * density."""
    before, now = np.ones_like(t), t
    if order == 0:
        return before
    for k in range(1, order):
        before, now = now, t * now - k * before
    return now


def _derivatives(order: int, u, v, g: float) -> list:
    """The even-order derivatives of the round normal density with deviation ``g``: entry k is k times along v."""
    base = np.exp(-(u * u + v * v) / (2 * g * g)) / (2 * math.pi * g * g)
    return [base * _hermite(order - k, u / g) * _hermite(k, v / g) / g**order for k in range(order + 1)]


def _pilot(order: int, above: Sequence[float], n: float) -> float:
    """The pilot bandwidth with the least summed squared bias of all derivatives of ``order``, given those two orders higher."""
    at_zero = [float(d) for d in _derivatives(order, np.zeros(()), np.zeros(()), 1.0)]
    bent = [above[k] + above[k + 2] for k in range(order + 1)]
    ways = [math.comb(order, k) for k in range(order + 1)]
    a1 = sum(w * a * a for w, a in zip(ways, at_zero))
    a2 = sum(w * a * b for w, a, b in zip(ways, at_zero, bent))
    a3 = sum(w * b * b for w, b in zip(ways, bent))
    u = (order * a2 + math.sqrt(order * order * a2 * a2 + 8 * (order + 2) * a1 * a3)) / (2 * a3)
    return (u / n) ** (1.0 / (order + 4))


def _plug_in(grid: np.ndarray, n: float, du: float, dv: float) -> np.ndarray:
    """The bandwidth matrix of round points of unit spread, from their shares on a grid."""
    nodes = grid.shape[0]
    turned = np.fft.rfft2(grid, (2 * nodes, 2 * nodes))
    pairs = np.fft.irfft2(np.abs(turned) ** 2, (2 * nodes, 2 * nodes))  # sums of products by distance between nodes
    lag = np.concatenate([np.arange(nodes), np.arange(-nodes, 0)])
    u, v = np.meshgrid(lag * du, lag * dv, indexing="ij")

    def functionals(order: int, g: float) -> list[float]:
        return [float((pairs * d).sum()) / (n * n) for d in _derivatives(order, u, v, g)]

    eighth = [float(d) for d in _derivatives(8, np.zeros(()), np.zeros(()), math.sqrt(2.0))]  # of a normal density
    sixth = functionals(6, _pilot(6, eighth, n))
    fourth = functionals(4, _pilot(4, sixth, n))
    return _least_error(fourth, n)


def _least_error(fourth: Sequence[float], n: float) -> np.ndarray:
    """The matrix with the least 1 / (4 pi n sqrt|H|) + (sum of H_ij H_kl psi_ijkl) / 4.

    A shape of unit determinant, exp(a) and b in it, decides the second part;
    its best size follows in closed form. Newton steps on the shape, halved
    until they improve.
    """
    p4, p31, p22, p13, p04 = fourth
    form = np.array([[p4, 2 * p31, p22], [2 * p31, 4 * p22, 2 * p13], [p22, 2 * p13, p04]])  # over (h_xx, h_xy, h_yy)
    normal = np.eye(2) * n ** (-1.0 / 3.0)

    def shape(z):
        return np.array([math.exp(z[0]), z[1], (1 + z[1] ** 2) * math.exp(-z[0])])

    def bend(z):
        m = shape(z)
        return float(m @ form @ m)

    z, at = np.zeros(2), bend(np.zeros(2))
    for _ in range(100):
        m = shape(z)
        da = np.array([m[0], 0.0, -m[2]])
        db = np.array([0.0, 1.0, 2 * z[1] * math.exp(-z[0])])
        slope = 2 * np.array([da @ form @ m, db @ form @ m])
        daa, dab, dbb = np.array([m[0], 0, m[2]]), np.array([0, 0, -db[2]]), np.array([0, 0, 2 * math.exp(-z[0])])
        curve = 2 * np.array(
            [[da @ form @ da + m @ form @ daa, da @ form @ db + m @ form @ dab],
             [da @ form @ db + m @ form @ dab, db @ form @ db + m @ form @ dbb]]
        )
        if not np.isfinite(slope).all() or at <= 0:
            return normal
        low = np.linalg.eigvalsh(curve)[0]
        if low <= 1e-9 * abs(curve).max():  # not curved upwards: lift it
            curve = curve + np.eye(2) * (abs(low) + 1e-3 * abs(curve).max())
        move, part = np.linalg.solve(curve, -slope), 1.0
        while part > 1e-12 and not bend(z + part * move) < at:
            part /= 2
        if part <= 1e-12:
            break
        z = z + part * move
        gained, at = at - bend(z), bend(z)
        if gained <= 1e-15 * abs(at):
            break
    if at <= 0 or abs(z[0]) > 10 or abs(z[1]) > 1e4:
        return normal
    size = (1 / (2 * math.pi * n * at)) ** (1.0 / 3.0)  # h squared: from -1 / (2 pi n h^3) + h^3 * bend = 0
    m = shape(z) * size
    return np.array([[m[0], m[1]], [m[1], m[2]]])
