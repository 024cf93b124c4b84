"""Expected use: substances that the companies of a catchment may emit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.functions.codes import plain_code
from tracewater.functions.text import address_text, wrap_label
from tracewater.operators.first import top_k_with_ties
from tracewater.operators.joins import in_set, join_with_attribute, not_in_set, null_safe_join, strict_join
from tracewater.operators.order import sort_nulls_last
from tracewater.operators.reshape import explode_parallel

# Statuses that enter the list, and their column labels.
STATUSES = {"Emissie verwacht": "expected", "Emissie mogelijk": "possible"}
SUBSTANCE = ["substance", "cas", "name_nl", "name_uk", "ec_nr", "smiles", "compartment"]


def company_codes(companies: DataFrame) -> DataFrame:
    """One row per company and code; sectors run parallel to codes."""
    return explode_parallel(companies, {"codes": ", ", "sectors": " | "}).withColumnsRenamed(
        {"codes": "code", "sectors": "sector"}
    )


def code_counts(companies: DataFrame, by: Sequence[str] = ("plant",)) -> DataFrame:
    """Companies per plant and code. A code shared by many companies is folded map-side."""
    return company_codes(companies).groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n_companies"))


def selection_codes(selection: DataFrame) -> DataFrame:
    return selection.withColumn("code_plain", plain_code(F.col("code_decimal")))


def selected_counts(counts: DataFrame, selection: DataFrame) -> DataFrame:
    return join_with_attribute(counts, selection_codes(selection), [("code", "code_plain")], "process")


def unselected_counts(counts: DataFrame, selection: DataFrame) -> DataFrame:
    """Codes outside the selection, per plant: number of codes and of companies.

    ``counts`` holds each (plant, code) once, a missing code included.
    """
    outside = not_in_set(counts, selection_codes(selection), [("code", "code_plain")])
    return outside.groupBy("plant").agg(F.count(F.lit(1)).alias("n_codes"), F.sum("n_companies").alias("n_companies"))


def with_substance_id(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A 256-bit digest of the columns, nulls told apart from texts, as a short grouping key."""
    content = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    return df.withColumn("substance_id", F.unhex(F.sha2(content, 256)))


def region_suspects(
    companies: DataFrame,
    selection: DataFrame,
    bridge: DataFrame,
    scores: Sequence[str] = (),
    statuses: dict[str, str] = STATUSES,
    names: DataFrame | None = None,
) -> DataFrame:
    """Per plant and substance: number of companies and of codes, by status; all plants in one job.

    Companies are folded to one row per (plant, code) before they meet the
    substances, and the fan-out carries a short substance id only; names and
    score texts come back at the end. As (plant, code) and (code, substance,
    status) are unique on both sides, counting the pairs counts the codes, and
    one aggregation gives all cells of the wide table. Further columns of
    ``names``, by ``substance``, are joined to the substances before they meet
    the plants. Both tables of the substances grow with the lists, so they are
    merged: files that pack well would pass for small enough to broadcast.
    """
    described = [*SUBSTANCE, *scores]
    listed = bridge.where(F.col("emission_status").isin(*statuses) & F.col("code_written").isNotNull())
    known = with_substance_id(listed.select("code_plain", "emission_status", *described), described)
    detail = known.select("substance_id", *described).distinct()
    if names is not None:
        detail = strict_join(detail, names.hint("merge"), ["substance"], spread_by=["substance_id"])
    links = known.select("code_plain", "substance_id", "emission_status").distinct().hint("merge")

    allowed = selection_codes(selection).where(F.col("process").isNotNull())
    counts = in_set(code_counts(companies), allowed, [("code", "code_plain")])
    met = null_safe_join(counts, links, [("code", "code_plain")], "inner")
    status = F.col("emission_status")
    cells = {}
    for value, label in statuses.items():
        cells[f"total_companies_{label}"] = F.sum(F.when(status == value, F.col("n_companies")))
        cells[f"unique_codes_{label}"] = F.nullif(F.count(F.when(status == value, 1)), F.lit(0))
    wide = met.groupBy("plant", "substance_id").agg(*[c.alias(n) for n, c in cells.items()])
    flags = {
        label: F.when(F.col(f"total_companies_{label}").isNotNull(), 1) for label in statuses.values()
    }
    shown = wide.withColumns(flags).join(detail.hint("merge"), "substance_id")
    return shown.select("plant", *described, *cells, *flags, *[c for c in detail.columns if c not in ("substance_id", *described)])


def sorted_region_suspects(suspects: DataFrame, statuses: dict[str, str] = STATUSES) -> DataFrame:
    labels = list(statuses.values())
    keys = [f"-total_companies_{s}" for s in labels] + [f"-unique_codes_{s}" for s in labels]
    return sort_nulls_last(suspects, "plant", *keys, "substance", tie_break=["cas"])


def group_totals(companies: DataFrame, selection: DataFrame) -> DataFrame:
    """Companies per plant and main group of the selected codes."""
    counted = selected_counts(code_counts(companies), selection)
    return counted.groupBy("plant", "main_group").agg(F.sum("n_companies").alias("total"))


def top_groups(totals: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest main groups per plant, ties kept, with a wrapped label."""
    return top_k_with_ties(totals, ["plant"], ["-total"], k).withColumn("label", wrap_label(F.col("main_group")))


def company_addresses(companies: DataFrame, selection: DataFrame) -> DataFrame:
    """Companies with a selected code, one row per code, with their address text."""
    chosen = join_with_attribute(
        company_codes(companies), selection_codes(selection), [("code", "code_plain")], "process"
    )
    return chosen.withColumn("address", address_text(F.col("street"), F.col("postcode"), F.col("town")))
