"""From inputs to the delivered list, with a written table where a result is used more than once."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tracewater.plans import bridge, emission, region, suspects
from tracewater.sources.sinks import write_stage


@dataclass(frozen=True)
class Inputs:
    navigator: DataFrame
    names: DataFrame
    pmt: DataFrame
    activity: DataFrame
    selection: DataFrame
    companies: DataFrame
    parameters: DataFrame
    register: DataFrame
    register_codes: DataFrame
    measurements: DataFrame
    compounds: DataFrame


@dataclass(frozen=True)
class Options:
    year: int
    load_digits: int = 2
    statuses: Mapping[str, str] = field(default_factory=lambda: dict(region.STATUSES))
    aliases: Mapping[str, str] = field(default_factory=dict)
    listed_by: tuple[str, ...] = ("substance", "cas", "name_nl", "emission_status")


def suspect_list(inputs: Inputs, options: Options, folder: str) -> DataFrame:
    """The delivered list, unsorted.

    The bridge, the parameter list and both sides of the merge each feed
    several later steps. They are written to ``folder`` (shared
    storage) and read back: each is computed once, later plans stay short, and
    a lost executor costs a re-read. The emissions need none of the others, so
    they run beside them.
    """
    with ThreadPoolExecutor(1) as beside:
        emissions = beside.submit(
            lambda: write_stage(
                emission.emission_union(
                    inputs.register,
                    inputs.measurements,
                    inputs.register_codes,
                    inputs.parameters,
                    options.year,
                    options.load_digits,
                ),
                f"{folder}/emissions",
            )
        )
        scores, listed, use = _expected_use(inputs, options, folder)
        reported = emissions.result()
    # The merge keeps the CAS numbers of both sides, so they are known before it.
    substances = use.select("cas").union(reported.select("cas"))
    classified = suspects.classify(suspects.enrich_compounds(substances, inputs.compounds))
    return suspects.final_list(suspects.merged_suspects(use, reported), classified, listed, scores)


def _expected_use(inputs: Inputs, options: Options, folder: str) -> tuple[list[str], DataFrame, DataFrame]:
    scores = [c for c in inputs.pmt.columns if c != "cas"]
    linked = write_stage(
        bridge.substance_bridge(inputs.navigator, inputs.names, inputs.pmt, inputs.activity), f"{folder}/bridge"
    )
    listed = write_stage(
        suspects.parameter_list(linked, inputs.parameters, options.listed_by), f"{folder}/parameter_list"
    )
    expected = region.region_suspects(
        inputs.companies, inputs.selection, linked, scores, dict(options.statuses), suspects.use_names(listed)
    )
    return scores, listed, write_stage(suspects.plant_alias(expected, options.aliases), f"{folder}/use")
