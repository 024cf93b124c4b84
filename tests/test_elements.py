"""Formulas and SMILES texts by element, against expected counts and classes."""

import pytest
from pyspark.sql import functions as F

from tracewater.functions import elements

FORMULAS = {
    "C12H10O2": {"C": 12, "H": 10, "O": 2}, "CHCl3": {"C": 1, "H": 1, "Cl": 3}, "Ca(OH)2": {"Ca": 1, "O": 2, "H": 2},
    "CH3(CH2)4CH3": {"C": 6, "H": 14}, "K4[Fe(CN)6]": {"K": 4, "Fe": 1, "C": 6, "N": 6}, "((CH3)2N)3P": {"C": 6, "H": 18, "N": 3, "P": 1},
    "CuSO4.5H2O": {"Cu": 1, "S": 1, "O": 9, "H": 10}, "CuSO4·5H2O": {"Cu": 1, "S": 1, "O": 9, "H": 10}, "Ca+2": {"Ca": 1}, "C2H3O2-": {"C": 2, "H": 3, "O": 2},
    "Co": {"Co": 1}, "CO": {"C": 1, "O": 1}, "": {}, "c6h6": None, "C(H": None, "CH)2": None, "C[H)2": None, "C?H": None, "C2(3H)": None, None: None,
    "C99999999999999999999": "any",
}
SMILES = {
    "CCO": {"C": 2, "O": 1}, "c1ccccc1Cl": {"C": 6, "Cl": 1}, "c1cc[nH]c1": {"C": 4, "N": 1}, "Cn1cnc2c1": {"C": 4, "N": 2},
    "CC[Hg]Br": {"C": 2, "Hg": 1, "Br": 1}, "[Fe+2]": {"Fe": 1}, "[13C@@H](F)I": {"C": 1, "F": 1, "I": 1}, "[se]1cccc1": {"Se": 1, "C": 4},
    "C[Sn](C)(C)C": {"C": 4, "Sn": 1}, "[Na+].[O-]C=O": {"Na": 1, "O": 2, "C": 1}, "Sc1ccccc1": {"S": 1, "C": 6}, "": {}, None: None,
}
CLASSES = [
    ("NaCl", "[Na+].[Cl-]", "Inorganic"), ("CHCl3", "ClC(Cl)Cl", "Organic"), ("C6H6S", "Sc1ccccc1", "Organic"),
    ("C10H10Fe", "[Fe]12C3C1C3C2", "Organometallic"), ("C4H10Zn", "CC[Zn]CC", "Organometallic"), ("C5H6N2", "Cn1cncc1", "Organic"),
    ("C4H12Sn", "C[Sn](C)(C)C", "Organometallic"), ("C2H3NaO2", "CC(=O)[O-].[Na+]", "Organic Ionic"), ("C3H9BO3", "COB(OC)OC", "Organometallic"),
    ("C6H5Br", "Brc1ccccc1", "Organic"), ("Co", "[Co]", "Inorganic"), (None, "CC", None), ("C2H6", None, None), ("H2O", None, "Inorganic"), ("??", "C", None),
]


def test_formulas(spark):
    df = spark.createDataFrame([(f,) for f in FORMULAS], "f string")
    got = {r.f: r.m for r in df.select("f", elements.formula_elements(F.col("f")).alias("m")).collect()}
    assert {f: m for f, m in got.items() if FORMULAS[f] != "any"} == {f: m for f, m in FORMULAS.items() if m != "any"}


def test_smiles(spark):
    df = spark.createDataFrame([(s,) for s in SMILES], "s string")
    assert {r.s: r.m for r in df.select("s", elements.smiles_elements(F.col("s")).alias("m")).collect()} == SMILES


@pytest.mark.parametrize("empty", [False, True])
def test_classes(spark, empty):
    df = spark.createDataFrame([] if empty else CLASSES, "f string, s string, want string")
    got = df.withColumn("got", elements.class_by_elements(F.col("f"), F.col("s"))).collect()
    assert [(r.f, r.s, r.got) for r in got] == ([] if empty else CLASSES)


def test_a_formula_is_read_once_however_often_its_atoms_are_named(spark):
    """A column named several times is worked out as often: there were seven loops over a formula's symbols, and one for each element."""
    many = "".join(f"{e}{n}" for n, e in enumerate(("C", "H", "Br", "Cl", "F", "I", "N", "O", "P", "S", "Si", "Se", "Zn", "Hg"), 2))
    found = spark.createDataFrame([(many,)], "f string").select(elements.formula_elements(F.col("f")).alias("m"))
    assert sum(found.first().m.values()) == sum(range(2, 16))
    assert found._jdf.queryExecution().analyzed().toString().count("aggregate(") == 2
