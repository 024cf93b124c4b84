"""Places: addresses to coordinates, catchments to postcodes, company density."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.functions.geodesy import to_rd
from tracewater.functions.text import normal_address
from tracewater.operators.bandwidth import matrix_density, plug_in_bandwidth
from tracewater.operators.columns import match_names
from tracewater.operators.contours import contour_segments, ring_arrays, ring_points
from tracewater.operators.density import band_levels, density_bands, kernel_density
from tracewater.operators.first import keep_first
from tracewater.operators.joins import strict_join
from tracewater.operators.rows import coverage
from tracewater.operators.similar import suggestions
from tracewater.operators.spatial import polygons_meeting
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage


def locate(df: DataFrame, register: DataFrame, overrides: DataFrame | None = None, address: str = "address") -> DataFrame:
    """Add ``latitude, longitude`` from a landed address register.

    Addresses meet in normal form. ``overrides(address, corrected)`` is keyed
    by the original address: a corrected row looks up the corrected text.
    The register is reduced to one row per address before the join.
    """
    known = keep_first(
        register.select(normal_address(F.col("address")).alias("__known"), "latitude", "longitude"),
        ["__known"], ["latitude", "longitude"], drop_null_keys=True,
    )
    keyed = df.withColumn("__own", normal_address(F.col(address)))
    if overrides is not None:
        corrected = keep_first(
            overrides.select(normal_address(F.col("address")).alias("__old"), normal_address(F.col("corrected")).alias("__new")),
            ["__old"], ["__new"], drop_null_keys=True,
        )
        keyed = strict_join(keyed, corrected, [("__own", "__old")]).withColumn(
            "__own", F.coalesce("__new", "__own")
        ).drop("__new")
    return strict_join(keyed, known, [("__own", "__known")]).drop("__own")


def location_report(located: DataFrame, address: str = "address") -> DataFrame:
    """How many addresses were found; each different address counts once."""
    single = located.groupBy(address).agg(F.max(F.col("longitude").isNotNull()).alias("found"))
    return coverage(single, F.col("found"), [address])


def address_suggestions(located: DataFrame, register: DataFrame, address: str = "address", edits: int = 1) -> DataFrame:
    """``address, suggestion, distance, rank, only``: register addresses near those that were not found.

    ``located`` is the result of ``locate``. Addresses are compared in normal
    form, and both sides show it. Rows with ``only`` can serve as overrides
    of the next run.
    """
    missed = located.filter(F.col("longitude").isNull()).select(normal_address(F.col(address)).alias(address))
    return suggestions(missed, address, register.select(normal_address(F.col("address")).alias("__known")), "__known", edits)


def company_density(
    addressed: DataFrame,
    register: DataFrame,
    step: tuple[float, float],
    bandwidth: tuple[float, float] | DataFrame | None,
    overrides: DataFrame | None = None,
    by: Sequence[str] = ("plant",),
    per_area: float = 1e6,
    digits: int = 9,
) -> DataFrame:
    """Where companies concentrate: density per grid node and its band, in metres of the national grid.

    ``addressed`` has one row per company and selected code, so a company
    with several codes weighs several times. Addresses not found take no part.
    Density is per ``per_area`` square metres, by default per square
    kilometre, rounded so that equal nodes compare equal. Without a
    ``bandwidth`` each group gets its plug-in matrix.
    """
    found, grid = _company_grid(addressed, register, step, bandwidth, overrides, by, per_area, digits)
    return density_bands(found, grid, by, "rd_x", "rd_y", step)


def company_contours(
    addressed: DataFrame,
    register: DataFrame,
    step: tuple[float, float],
    bandwidth: tuple[float, float] | DataFrame | None,
    overrides: DataFrame | None = None,
    by: Sequence[str] = ("plant",),
    shares: Sequence[int] = (10, 25, 50, 75, 90),
    per_area: float = 1e6,
    digits: int = 9,
) -> DataFrame:
    """``by, band, ring, area, points``: the outlines of the bands of ``company_density``, holes with negative areas."""
    found, grid = _company_grid(addressed, register, step, bandwidth, overrides, by, per_area, digits)
    grid = write_stage(grid, shared_folder(grid.sparkSession, "density"))
    levels = band_levels(found, grid, by, "rd_x", "rd_y", step, shares)
    return ring_arrays(ring_points(contour_segments(grid, by, "density", levels, step), by), by)


def _company_grid(addressed, register, step, bandwidth, overrides, by, per_area, digits):
    found = with_rd(locate(addressed, register, overrides).where(F.col("longitude").isNotNull()))
    if bandwidth is None:
        matrix = plug_in_bandwidth(found, by, "rd_x", "rd_y")
        matrix = write_stage(matrix, shared_folder(found.sparkSession, "bandwidth"))
        grid = matrix_density(found, by, "rd_x", "rd_y", step, matrix)
    else:
        grid = kernel_density(found, by, "rd_x", "rd_y", step, bandwidth)
    return found, grid.withColumn("density", F.round(F.col("density") * F.lit(per_area), digits))


def with_rd(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    x, y = to_rd(F.col(lon), F.col(lat))
    return df.withColumns({"rd_x": x, "rd_y": y})


def rings_to_rd(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Polygon column from longitude/latitude to the national grid."""

    def moved(p):
        x, y = to_rd(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return df.withColumn(rings, F.transform(rings, lambda ring: F.transform(ring, moved)))


def catchment_postcodes(
    catchments: DataFrame, postcodes: DataFrame, plants: Sequence[str], cell: float = 2000.0
) -> DataFrame:
    """Distinct ``plant, postcode6`` whose areas overlap or touch; both inputs in metres."""
    chosen = match_names(catchments, "naam", plants, "plant")
    return polygons_meeting(postcodes, "rings", ["postcode6"], chosen, "rings", ["plant"], cell).select(
        "plant", "postcode6"
    )
