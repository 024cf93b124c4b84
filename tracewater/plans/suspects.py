"""The final list: substance groups, expected use, reported and measured loads, compound class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.functions.chemistry import DEFAULT_RULES, ORGANIC_CLASSES, Rule, chemical_class
from tracewater.operators.first import keep_first, keep_first_chain
from tracewater.operators.joins import full_merge, null_safe_join, strict_join
from tracewater.operators.order import sort_nulls_last
from tracewater.operators.reshape import group_text
from tracewater.operators.rows import repeated_keys
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage

# Fixed values of the inputs.
SINGLE_SUBSTANCES = "Individuele stoffen"
NO_CAS = "NVT"
REPEAT_KEYS = ["substance", "cas", "name_nl", "emission_status"]


def parameter_list(
    bridge: DataFrame, parameters: DataFrame, detail: Sequence[str], repeat_keys: Sequence[str] = tuple(REPEAT_KEYS)
) -> DataFrame:
    """Substances with their parameter codes and all their groups in one text ``groups``.

    ``detail`` are the substance columns to keep. Of substances that still
    occur more than once, all rows sharing their CAS number are repaired: one
    row per content, and none where the CAS number is the no-CAS mark or
    missing.
    """
    listed = bridge.select("substance_group", *detail).distinct()
    coded = null_safe_join(
        listed, parameters.select("casnummer", "id", "codes", "omschrijving"), [("cas", "casnummer")]
    )
    ids = [*detail, "id", "codes", "omschrijving"]
    grouped = group_text(coded, ids, "substance_group", "groups", first_tag=SINGLE_SUBSTANCES)
    affected = repeated_keys(grouped, *repeat_keys).select("cas").distinct().withColumn("__affected", F.lit(True))
    checked = null_safe_join(grouped, affected, ["cas"])
    # Rows differ in more than ``groups`` already, so the repair has nothing to
    # fold; what it does is drop affected rows without a CAS number.
    return checked.where(F.col("__affected").isNull() | (F.col("cas") != NO_CAS)).drop("__affected")


def plant_alias(df: DataFrame, aliases: Mapping[str, str], column: str = "plant") -> DataFrame:
    """Rename some plants, keep the others. The mapping is a literal in the expression."""
    if not aliases:
        return df
    literal = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return df.withColumn(column, F.coalesce(F.try_element_at(literal, F.col(column)), F.col(column)))


def use_names(parameter_names: DataFrame) -> DataFrame:
    """The parameters' ids, codes and texts of each substance, for the expected use."""
    return parameter_names.select(
        "substance", F.col("id").alias("use_id"), F.col("codes").alias("use_code"), F.col("omschrijving").alias("use_text")
    ).distinct()


def merged_suspects(use: DataFrame, emissions: DataFrame) -> DataFrame:
    """Expected use and emissions side by side per (CAS, plant); either may be missing.

    The merge reads each side in three places: pass written tables.
    """
    merged = full_merge(
        use,
        emissions,
        ["cas", "plant"],
        coalesce=[
            ("use_id", "parameter_id", "aquo_id"),
            ("use_code", "parameter_code", "aquo_code"),
            ("use_text", "description", "aquo_text"),
        ],
    )
    return merged.withColumn("substance", F.coalesce("substance", "register_name"))


def enrich_compounds(substances: DataFrame, compounds: DataFrame, order: Sequence[str] = ("cas",)) -> DataFrame:
    """One row per distinct CAS with its first compound; then one row per SMILES.

    Of several CAS numbers with the same SMILES only the first under ``order``
    keeps its properties, and a missing SMILES counts as one value.
    """
    wanted = keep_first(substances, ["cas"], [*order], drop_null_keys=True).select("cas", *[c for c in order if c != "cas"])
    first = keep_first(compounds, ["cas"], [F.col("cid").try_cast("bigint").asc_nulls_last(), "cid"], drop_null_keys=True)
    found = strict_join(wanted, first.where(F.col("cid").isNotNull()), ["cas"], "inner")
    found = found.withColumn("smiles", F.trim("smiles"))
    return keep_first_chain(found, [["smiles"]], [*order])


def classify(compounds: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add ``chemical_class``; rows that cannot be classified or have no compound id are dropped."""
    label = chemical_class(F.col("formula"), F.col("smiles"), rules)
    return compounds.withColumn("chemical_class", label).where(
        F.col("chemical_class").isNotNull() & F.col("cid").isNotNull()
    )


FINAL_ORDER = [
    "plant", "-emission", "chemical_class", "-expected", "-total_companies_expected", "-unique_codes_expected",
    "-possible", "-total_companies_possible", "-unique_codes_possible",
]

# Column titles of the delivered list.
DISPLAY_NAMES = {
    "plant": "case_study",
    "chemical_class": "Stofgroep",
    "groups": "ZZS_Stofgroepen",
    "substance": "Stofnaam",
    "cas": "CAS-nummer",
    "aquo_id": "AQUO_id",
    "aquo_code": "AQUO_code",
    "aquo_text": "AQUO_omschrijving",
    "cid": "CID",
    "formula": "Molecuulformule",
    "compound_smiles": "SMILES",
    "inchi_key": "InChIKey",
    "mass": "MonoisotopicMass",
    "charge": "Lading_molecuul",
    "title": "naam_pubchem",
    "name_nl": "RIVM_naam_nl",
    "ec_nr": "EC_nr",
    "expected": "Emissie_verwacht",
    "total_companies_expected": "Emissie_verwacht_totaal_bedrijven",
    "unique_codes_expected": "Emissie_verwacht_unieke_SBIcodes",
    "possible": "Emissie_mogelijk",
    "total_companies_possible": "Emissie_mogelijk_totaal_bedrijven",
    "unique_codes_possible": "Emissie_mogelijk_unieke_SBIcodes",
    "register_code": "ER_stofcode",
    "register_name": "Gepresenteerde Stofnaam ER",
    "company": "Bedrijf",
    "code_name": "Sbi",
    "emission": "Emissie",
    "unit": "Eenheid",
    "year": "Emissiejaar",
    "origin": "ER_Herkomst",
    "dataset": "ER_Dataset",
}


def final_list(merged: DataFrame, classified: DataFrame, groups: DataFrame, scores: Sequence[str] = ()) -> DataFrame:
    """Merged suspects with class, compound properties and group text, in the delivered column order."""
    compound = ["cid", "formula", "smiles", "inchi_key", "mass", "charge", "title", "chemical_class"]
    properties = classified.select("cas", *compound).withColumnRenamed("smiles", "compound_smiles")
    # No CAS number is missing among the properties, so missing ones need not meet there.
    classed = strict_join(merged, properties, ["cas"], spread_by=["plant", "substance", "company"])
    named = null_safe_join(classed, groups.select("groups", "substance", "cas").distinct(), ["substance", "cas"])
    return named.select(*DISPLAY_NAMES, *scores)


def sorted_final_list(final: DataFrame) -> DataFrame:
    """A global sort reads its rows twice, to cut the ranges and to sort; the list is written before, so that it is made once."""
    final = write_stage(final, shared_folder(final.sparkSession, "final"))
    return sort_nulls_last(final, *FINAL_ORDER, tie_break=["cas", "company", "register_name"])


def organic_part(final: DataFrame, strict: bool = False) -> DataFrame:
    """Organic classes. ``strict`` leaves out the ionic ones, as lists made with a misspelt label did."""
    wanted = [c for c in ORGANIC_CLASSES if not (strict and c == "Organic Ionic")]
    return final.where(F.col("chemical_class").isin(*wanted))
