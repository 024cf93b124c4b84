"""Reported emissions and measured loads under one schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.functions.numbers import annual_load, tolerant_double, tolerant_int
from tracewater.functions.text import text_or_na, title_case
from tracewater.operators.joins import null_safe_join
from tracewater.operators.order import sort_nulls_last
from tracewater.operators.rows import append_widen

COLUMNS = [
    "plant", "parameter_code", "parameter_id", "cas", "description", "register_code", "register_name",
    "company", "code_name", "emission", "unit", "year", "origin", "dataset",
]
ALL = "Alle"  # fixed value: the export's row over all years or all plants


def register_of_plants(register: DataFrame, plant_postcodes: DataFrame) -> DataFrame:
    """Register rows of each plant's postcodes; a row may belong to several plants."""
    pairs = plant_postcodes.select("plant", F.col("postcode6").alias("__pc")).distinct()
    return register.join(pairs, F.col("postcode").eqNullSafe(F.col("__pc"))).drop("__pc")


def yearly_loads(measurements: DataFrame, digits: int = 2) -> DataFrame:
    """Plant rows over all years with a positive median, as kg per year."""
    kept = measurements.where((F.col("year") == ALL) & (F.col("median") > 0) & (F.col("plant_code") != ALL))
    return kept.withColumn("load", annual_load(F.col("median"), digits))


def register_emissions(register: DataFrame, register_codes: DataFrame, parameters: DataFrame) -> DataFrame:
    coded = null_safe_join(
        register.withColumn("substance_code", tolerant_int(F.col("substance_code"))),
        register_codes,
        [("substance_code", "register_code"), ("substance_name", "register_name")],
    )
    named = null_safe_join(coded, parameters.select("codes", "id", "casnummer", "omschrijving"), [("parameter_code", "codes")])
    return named.select(
        "plant", "parameter_code", F.col("id").alias("parameter_id"), F.col("casnummer").alias("cas"),
        F.col("omschrijving").alias("description"), F.col("substance_code").alias("register_code"),
        F.col("substance_name").alias("register_name"), "company", "code_name", "emission", "unit",
        "year", "origin", "dataset",
    )


def measured_emissions(measurements: DataFrame, parameters: DataFrame, year: int, digits: int = 2) -> DataFrame:
    """Measured loads in the register's columns, with the plant itself as the company."""
    loads = null_safe_join(
        yearly_loads(measurements, digits).drop("year"),
        parameters.select("codes", "id", "omschrijving"),
        [("parameter_code", "codes")],
    )
    place = text_or_na(title_case(F.col("location")))
    # Fixed texts of the output schema.
    return loads.select(
        place.alias("plant"), "parameter_code", F.col("id").alias("parameter_id"), "cas",
        F.col("omschrijving").alias("description"), tolerant_double(F.col("register_code")).alias("register_code"),
        F.col("substance_name").alias("register_name"), F.concat(F.lit("RWZI "), place).alias("company"),
        F.lit("Afvalwaterinzameling en -behandeling").alias("code_name"), F.col("load").alias("emission"),
        F.lit("kg").alias("unit"), F.lit(float(year)).alias("year"),
        F.lit("Inschatting o.b.v. Watson 3 jarig gem. influent concentratie data").alias("origin"),
        F.lit(f"Watson database ER - {year}").alias("dataset"),
    )


def emission_union(
    register: DataFrame,
    measurements: DataFrame,
    register_codes: DataFrame,
    parameters: DataFrame,
    year: int,
    digits: int = 2,
) -> DataFrame:
    return append_widen(
        register_emissions(register, register_codes, parameters),
        measured_emissions(measurements, parameters, year, digits),
    ).select(*COLUMNS)


def sorted_emissions(emissions: DataFrame, tie_break: Sequence[str] = ("company", "register_name")) -> DataFrame:
    return sort_nulls_last(emissions, "plant", "-emission", tie_break=tie_break)
