"""Elements of chemical formulas and SMILES texts, and a chemical class that follows from them.

The pattern rules in ``chemistry`` guess metals from letters. Here a text is cut into symbols first, so iron or zinc are
known as such and an aromatic ``n`` after another letter is not taken for nickel or sodium. All of it are column
expressions. A value that is used several times is bound first (``_let``): a column that is merely named twice is worked
out twice, and once more for each element of a list if the name stands in a lambda.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose presence beside carbon does not make a compound organometallic.
NONMETALS = ("H", "D", "T", "He", "C", "N", "O", "F", "Ne", "P", "S", "Cl", "Ar", "Br", "Kr", "I", "Xe")

# A symbol of a SMILES text: in brackets after an isotope number, or one of the symbols that need no brackets.
SMILES_SYMBOL = r"\[[0-9]*([A-Z][a-z]?|[a-z][a-z]?)[^\]]*\]|(Cl|Br|[BCNOPSFI]|[bcnops])"
_TOKEN = r"[A-Z][a-z]?|[0-9]+|[()\[\]{}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _counts(names: Column, n_of: Callable[[Column], Column]) -> Column:
    """``map<string, bigint>``: ``n_of`` each different name, in their first order."""
    return F.map_from_entries(F.transform(F.array_distinct(names), lambda e: F.struct(e, n_of(e))))


def formula_elements(formula: Column) -> Column:
    """``map<string, bigint>``: atoms of each element; null where the text is null or no formula.

    Groups in round, square or curly brackets may be nested and multiplied,
    parts after a dot may have a leading number (CuSO4.5H2O), and a charge at
    the end of a sign with a number after it (Ca+2), or of a bare sign, does not
    count. Anything else, such as lower case starts, unknown signs and brackets
    that do not pair up, gives null; an empty text gives an empty map.
    """
    plain = F.regexp_replace(F.regexp_replace(F.trim(formula), r"[+-][0-9]*$", ""), "·", ".")
    return _let(plain, lambda text: F.when(text.rlike(r"^[A-Za-z0-9()\[\]{}.]*$"), _let(_atoms(text), _summed)))


def _atoms(plain: Column) -> Column:
    return F.flatten(F.transform(F.filter(F.split(plain, r"\."), lambda p: p != ""), _part))


def _summed(found: Column) -> Column:
    """The atoms of each element in an ``array<struct<e, n>>``."""
    return _counts(
        F.transform(found, lambda a: a["e"]),
        lambda e: F.aggregate(found, F.lit(0).cast("bigint"), lambda n, a: n + F.when(a["e"] == e, a["n"]).otherwise(0)),
    )


def _part(part: Column) -> Column:
    """``array<struct<e, n>>`` of a part without dots; null if it is no formula.

    The symbols are read from the right: a number waits for the symbol or the
    closing bracket before it, and a closing bracket puts its product on a
    stack until the opening one.
    """
    leading = F.regexp_extract(part, "^[0-9]+", 0)
    rest = F.regexp_replace(part, "^[0-9]+", "")
    times = F.when(leading == "", F.lit(1).cast("bigint")).otherwise(leading.try_cast("bigint"))
    read = F.struct(times.alias("times"), rest.alias("rest"), F.reverse(F.regexp_extract_all(rest, F.lit(_TOKEN), 0)).alias("tokens"))
    return _let(read, lambda p: _from_tokens(p["times"], p["rest"], p["tokens"]))


def _from_tokens(times: Column, rest: Column, tokens: Column) -> Column:
    start = F.struct(
        F.array(times).alias("stack"), F.array().cast("array<string>").alias("shut"), F.lit(1).cast("bigint").alias("wait"),
        F.lit(False).alias("bad"), F.array().cast("array<struct<e:string,n:bigint>>").alias("found"),
    )

    def step(s: Column, t: Column) -> Column:
        top = F.element_at(s["stack"], -1)
        number, closes, opens = t.rlike("^[0-9]"), t.isin(")", "]", "}"), t.isin("(", "[", "{")
        symbol = ~(number | closes | opens)
        one = F.lit(1).cast("bigint")
        lower = F.slice(s["stack"], 1, F.greatest(F.size(s["stack"]) - 1, F.lit(1)))
        pairs = F.coalesce(F.get(s["shut"], F.size(s["shut"]) - 1) == F.translate(t, "([{", ")]}"), F.lit(False))
        return F.struct(
            F.when(closes, F.array_append(s["stack"], top * s["wait"])).when(opens, lower).otherwise(s["stack"]).alias("stack"),
            F.when(closes, F.array_append(s["shut"], t))
            .when(opens, F.slice(s["shut"], 1, F.greatest(F.size(s["shut"]) - 1, F.lit(0)))).otherwise(s["shut"]).alias("shut"),
            F.when(number, t.try_cast("bigint")).otherwise(one).alias("wait"),
            (s["bad"] | (opens & (~pairs | (s["wait"] != 1)))).alias("bad"),
            F.when(symbol, F.array_append(s["found"], F.struct(t.alias("e"), (top * s["wait"]).alias("n"))))
            .otherwise(s["found"]).alias("found"),
        )

    whole = F.concat_ws("", F.reverse(tokens)) == rest
    readable = whole & times.isNotNull() & ~rest.rlike(r"[(\[{][0-9]")
    end = F.aggregate(tokens, start, step)
    return F.when(readable, _let(end, lambda s: F.when(~s["bad"] & (F.size(s["shut"]) == 0), s["found"])))


def smiles_elements(smiles: Column) -> Column:
    """``map<string, bigint>``: the atoms written in a SMILES text by element; hydrogens count only where written as atoms.

    Aromatic atoms (``c``, ``[nH]``, ``[se]``) count under their element. Null gives null.
    """
    inside = F.regexp_extract_all(smiles, F.lit(SMILES_SYMBOL), 1)
    outside = F.regexp_extract_all(smiles, F.lit(SMILES_SYMBOL), 2)
    symbols = F.filter(F.transform(F.arrays_zip(inside.alias("i"), outside.alias("o")), lambda p: F.initcap(F.concat(p["i"], p["o"]))), lambda s: s != "")
    return _let(symbols, lambda all: _counts(all, lambda e: F.size(F.filter(all, lambda s: s == e)).cast("bigint")))


def class_by_elements(formula: Column, smiles: Column) -> Column:
    """Inorganic, Organic, Organic Ionic or Organometallic, from elements instead of letters.

    Without carbon in the formula: Inorganic. Else, as the pattern rules order
    it, several parts in the SMILES: Organic Ionic; any element outside
    ``NONMETALS`` in the formula or the SMILES: Organometallic; else Organic.
    Null without a readable formula, and, for compounds with carbon, without a SMILES.
    """
    nonmetals = F.array(*[F.lit(e) for e in NONMETALS])

    def metals(of_formula: Column) -> Column:
        return F.array_except(F.array_union(of_formula, F.map_keys(smiles_elements(smiles))), nonmetals)

    return _let(
        F.map_keys(formula_elements(formula)),
        lambda of_formula: F.when(of_formula.isNull(), None)
        .when(~F.array_contains(of_formula, "C"), "Inorganic")
        .when(smiles.isNull(), None)
        .when(F.contains(smiles, F.lit(".")), "Organic Ionic")
        .when(F.size(metals(of_formula)) > 0, "Organometallic")
        .otherwise("Organic"),
    )
