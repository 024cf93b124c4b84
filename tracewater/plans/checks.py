"""Reports on what was linked and what was lost along the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.operators.joins import not_in_set
from tracewater.operators.rows import coverage


def parameter_link_rate(parameter_list: DataFrame) -> DataFrame:
    """Share of listed substances that have a parameter code."""
    return coverage(parameter_list, F.col("codes").isNotNull(), ["cas"], digits=0)


def unlinked_register(emissions: DataFrame) -> DataFrame:
    """Register substances without a parameter code, or whose code has no description."""
    return (
        emissions.where(F.col("parameter_code").isNull() | F.col("description").isNull())
        .select("register_code", "register_name", F.col("parameter_code").isNull().alias("without_code"))
        .distinct()
    )


def register_sizes(placed: DataFrame) -> DataFrame:
    """Register rows and companies per plant."""
    companies = placed.select("plant", "nic", "company").distinct()
    n_rows = placed.groupBy("plant").agg(F.count(F.lit(1)).alias("n_rows"))
    return n_rows.join(companies.groupBy("plant").agg(F.count(F.lit(1)).alias("n_companies")), "plant")


def postcode_sizes(plant_postcodes: DataFrame, distinct: bool = False) -> DataFrame:
    """Postcodes per plant, and how many four-digit areas they span.

    Counted step by step, since two distinct counts at once would double the
    pairs. A missing postcode is not counted, a plant with no other has zeros.
    ``distinct``: the pairs already are, so they are not shuffled for it.
    """
    area = F.substring(F.col("postcode6").cast("string"), 1, 4)
    each = plant_postcodes.select("plant", "postcode6")
    each = each if distinct else each.distinct()
    by_area = each.groupBy("plant", area.alias("area")).agg(F.count("postcode6").alias("n"))
    return by_area.groupBy("plant").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_postcodes"), F.count("area").alias("n_areas"))


def suspects_summary(merged: DataFrame) -> DataFrame:
    """Rows, different CAS numbers and plants; a missing value is one value."""
    return coverage(merged, F.col("cas").isNotNull(), ["cas", "plant"])


def without_compound(substances: DataFrame, compounds: DataFrame) -> DataFrame:
    """Substances with a CAS number for which no compound id is known."""
    known = compounds.where(F.col("cid").isNotNull())
    return not_in_set(substances.where(F.col("cas").isNotNull()).select("cas", "substance").distinct(), known, ["cas"])


def smiles_losses(found: DataFrame) -> DataFrame:
    """How many CAS numbers lose their properties because another one has the same SMILES."""
    kept = F.count_distinct("smiles") + F.coalesce(F.max(F.col("smiles").isNull().cast("int")), F.lit(0))
    n = F.count(F.lit(1))
    return found.agg(
        n.alias("n_cas"), (n - kept).alias("n_lost"), F.round(F.when(n > 0, 100.0 * (n - kept) / n), 1).alias("lost_pct")
    )


def class_totals(classified: DataFrame) -> DataFrame:
    return classified.groupBy("chemical_class").agg(F.count(F.lit(1)).alias("n"))
