"""Chemical class by ordered text rules on formula and SMILES."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``label`` holds when ``field`` matches (or with ``absent``, lacks) ``pattern``."""

    label: str
    field: str  # "formula" or "smiles"
    pattern: str
    absent: bool = False


# Patterns and labels, in order of precedence. A lone carbon
# such as CHCl3 has no digit after its C and therefore counts as inorganic.
# The metal patterns are approximate by design (no iron or zinc, for example);
# pass another list to change that.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("Inorganic", "formula", "C[1-9]", absent=True),
    Rule("Organic Ionic", "smiles", r"\."),
    Rule("Organometallic", "smiles", "C[adenorus]"),
    Rule("Organometallic", "smiles", "S[bceni]"),
    Rule("Organometallic", "smiles", "Pb"),
    Rule("Organometallic", "smiles", "Hg"),
    Rule("Organometallic", "smiles", "[AKMYLG]"),
    Rule("Organometallic", "smiles", "N[a-z]"),
    Rule("Organometallic", "smiles", "B[^r]"),
)
DEFAULT_CLASS = "Organic"
ORGANIC_CLASSES = ("Organic", "Organic Ionic", "Organometallic")


def chemical_class(
    formula: Column, smiles: Column, rules: Sequence[Rule] = DEFAULT_RULES, default: str = DEFAULT_CLASS
) -> Column:
    """First rule that holds, else ``default``; null where the class cannot be told.

    Without a formula nothing can be told. Without a SMILES only rules on the
    formula can decide.
    """
    fields = {"formula": formula, "smiles": smiles}
    label = F.when(formula.isNull(), None)
    smiles_checked = False
    for rule in rules:
        if rule.field == "smiles" and not smiles_checked:
            label = label.when(smiles.isNull(), None)
            smiles_checked = True
        found = fields[rule.field].rlike(rule.pattern)
        label = label.when(~found if rule.absent else found, rule.label)
    if not smiles_checked:
        label = label.when(smiles.isNull(), None)
    return label.otherwise(default)
