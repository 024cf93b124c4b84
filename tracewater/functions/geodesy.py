"""WGS84 longitude/latitude to and from the Dutch national grid (EPSG:28992).

Published polynomial approximation (Schreutelkamp and Strang van Hees, 2001)
around the Amersfoort origin. Inside the Netherlands it stays within about
0.3 m of the official transformation; outside it is not meant to be used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Origin and coefficients (power of first, power of second, value).
LAT0, LON0, X0, Y0 = 52.15517440, 5.38720621, 155000.0, 463000.0
_X = [
    (0, 1, 190094.945), (1, 1, -11832.228), (2, 1, -114.221), (0, 3, -32.391), (1, 0, -0.705),
    (3, 1, -2.340), (1, 3, -0.608), (0, 2, -0.008), (2, 3, 0.148),
]
_Y = [
    (1, 0, 309056.544), (0, 2, 3638.893), (2, 0, 73.077), (1, 2, -157.984), (3, 0, 59.788),
    (0, 1, 0.433), (2, 2, -6.439), (1, 1, -0.032), (0, 4, 0.092), (1, 4, -0.054),
]
_LAT = [
    (0, 1, 3235.65389), (2, 0, -32.58297), (0, 2, -0.24750), (2, 1, -0.84978), (0, 3, -0.06550),
    (2, 2, -0.01709), (1, 0, -0.00738), (4, 0, 0.00530), (2, 3, -0.00039), (4, 1, 0.00033), (1, 1, -0.00012),
]
_LON = [
    (1, 0, 5260.52916), (1, 1, 105.94684), (1, 2, 2.45656), (3, 0, -0.81885), (1, 3, 0.05594),
    (3, 1, -0.05607), (0, 1, 0.01199), (3, 2, -0.00256), (1, 4, 0.00128), (0, 2, 0.00022),
    (2, 0, -0.00022), (5, 0, 0.00026),
]


def _polynomial(terms, u: Column, v: Column) -> Column:
    total = F.lit(0.0)
    for p, q, value in terms:
        term = F.lit(value)
        for _ in range(p):
            term = term * u
        for _ in range(q):
            term = term * v
        total = total + term
    return total


def to_rd(lon: Column, lat: Column) -> tuple[Column, Column]:
    u, v = F.lit(0.36) * (lat - LAT0), F.lit(0.36) * (lon - LON0)
    return F.lit(X0) + _polynomial(_X, u, v), F.lit(Y0) + _polynomial(_Y, u, v)


def to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude, latitude."""
    u, v = (x - X0) * F.lit(1e-5), (y - Y0) * F.lit(1e-5)
    return F.lit(LON0) + _polynomial(_LON, u, v) / 3600.0, F.lit(LAT0) + _polynomial(_LAT, u, v) / 3600.0
