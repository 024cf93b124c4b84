"""Substances to business codes: which codes stand for an activity that may emit a substance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.functions.codes import code_forms
from tracewater.operators.columns import col_range
from tracewater.operators.joins import in_each_column, null_safe_join
from tracewater.operators.reshape import pivot_flags

IDENTITY = ["division", "substance_group", "substance", "cas"]
LISTING = ["division", "branch", "sub_branch", "compartment", "substance_group", "substance", "cas", "emission_status"]


def with_code_forms(activity: DataFrame, code: str = "code") -> DataFrame:
    """Replace the written code by its forms: as written, dotted, plain, padded."""
    forms = code_forms(F.col(code))
    return activity.withColumns({f"code_{name}": form for name, form in forms.items()}).withColumnRenamed(
        code, "code_written"
    )


def _identities(listing: DataFrame) -> DataFrame:
    """Each (division, group, substance, CAS) once, and whether any branch lists it."""
    return listing.groupBy(*IDENTITY).agg(F.max(F.col("branch").isNotNull()).alias("in_branch"))


def branchless(navigator: DataFrame) -> DataFrame:
    """Substances listed for a division that no branch of it lists.

    As a set this is the branch-less identities minus those within a branch;
    one grouping answers it, nulls compare equal.
    """
    return _identities(navigator).where(~F.col("in_branch")).drop("in_branch")


def clean_listing(navigator: DataFrame) -> DataFrame:
    """Named substances of the branch lists, plus those only a division lists.

    Added are rows whose division, group, substance and CAS each occur among
    the branch-less ones, independently. The four memberships are tested on
    the identities, which are far fewer than the rows, and the rows are
    joined once.
    """
    listing = navigator.where(F.col("substance").isNotNull()).select(*LISTING).distinct()
    identities = _identities(listing)
    lone = identities.where(~F.col("in_branch"))
    added = in_each_column(identities.select(*IDENTITY), lone, IDENTITY).withColumn("__added", F.lit(True))
    marked = null_safe_join(listing, added, IDENTITY)
    return marked.where(F.col("branch").isNotNull() | F.col("__added")).select(*LISTING)


def substance_properties(names: DataFrame, pmt: DataFrame) -> DataFrame:
    """Names, EC number and SMILES with the mobility scores."""
    return null_safe_join(names, pmt, ["cas"])


def substance_bridge(navigator: DataFrame, names: DataFrame, pmt: DataFrame, activity: DataFrame) -> DataFrame:
    """One row per (substance listing, business code).

    The activity join fans out many-to-many, so it runs on the narrow listing
    and the wide property texts are attached to its result's substances.
    Rows without a code are dropped, which makes the join an inner one.
    """
    coded = with_code_forms(activity).where(F.col("code_plain").isNotNull())
    expanded = null_safe_join(clean_listing(navigator), coded, ["division", "branch", "sub_branch"], "inner")
    properties = substance_properties(names, pmt)
    enriched = null_safe_join(
        expanded, properties, [("substance", "name_nl"), ("cas", "cas")], keep_keys=True, suffix="_listed"
    ).drop("cas_listed")
    lead = ["code_plain", "code_padded", "code_written", "code_decimal", "code_name", "activity_nr"]
    detail = ["division", "branch", "sub_branch", "substance_group", "substance", "cas"]
    naming = ["name_nl", "name_uk", "ec_nr", "smiles", "emission_status", "compartment"]
    scores = [c for c in pmt.columns if c != "cas"]
    return enriched.select(*lead, *detail, *naming, *scores)


def substance_code_matrix(bridge: DataFrame, codes: list[str]) -> DataFrame:
    """Wide form for a report: one row per substance, one 1/null column per listed code."""
    ids = col_range(bridge, "substance_group", bridge.columns[-1])
    return pivot_flags(bridge.select("code_decimal", *ids).distinct(), ids, "code_decimal", codes)
