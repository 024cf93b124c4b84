"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word runs over letters, digits and inner apostrophes or dots; everything
# else (blank, hyphen, leading apostrophe) stands between words.
_WORD_OR_GAP = r"([\p{L}\p{N}_]+(?:['’.:·][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_]+)"


def tidy_list(col: Column, separator: str) -> Column:
    """Split on a literal separator."""
    return F.split(col, re.escape(separator))


def replace_first(col: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match only. ``pattern`` must hold no capturing group."""
    return F.regexp_replace(col, rf"(?s)\A(.*?)(?:{pattern})", "$1" + replacement)


def strip_suffix(col: Column, suffix: str) -> Column:
    return F.when(F.endswith(col, F.lit(suffix)), F.left(col, F.length(col) - len(suffix))).otherwise(col)


def wrap_label(col: Column, width: int = 30) -> Column:
    """Break the line at the first blank after ``width`` characters, once."""
    return F.regexp_replace(col, rf"\A(.{{{width}}}\S*)\s", "$1\n")


def safe_file_name(col: Column) -> Column:
    return F.regexp_replace(col, "[^A-Za-z0-9]", "_")


def title_case(col: Column) -> Column:
    """Capital at the start of each word, where hyphens also end a word."""
    words = F.regexp_extract_all(F.lower(col), F.lit(_WORD_OR_GAP), 1)
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        "",
    )


def text_or_na(col: Column) -> Column:
    """A missing value as the text ``NA``, where pasted text shows it."""
    return F.coalesce(col.cast("string"), F.lit("NA"))


def address_text(street: Column, postcode: Column, town: Column, country: str = "Netherlands") -> Column:
    return F.concat(
        text_or_na(street), F.lit(", "), text_or_na(postcode), F.lit(", "), text_or_na(town), F.lit(f", {country}")
    )


def normal_address(col: Column) -> Column:
    """Address in the form used as a lookup key: upper case, single blanks, no blank around commas."""
    return F.regexp_replace(F.regexp_replace(F.upper(F.trim(col)), r"\s+", " "), r"\s*,\s*", ", ")


def null_if_na(col: Column) -> Column:
    """Text files write a missing value as ``NA``."""
    return F.nullif(col, F.lit("NA"))


def comma_decimal(col: Column) -> Column:
    """A number as text with a decimal comma, without exponent or trailing zeros.

    Built from the number's own shortest text, so no digit is lost.
    """
    shown = col.cast("string")
    exponent = F.coalesce(F.nullif(F.regexp_extract(shown, r"E(-?\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    body = F.regexp_replace(F.ltrim(shown, F.lit("-")), r"E-?\d+$", "")
    whole = F.substring_index(body, ".", 1)
    digits = F.replace(body, F.lit("."), F.lit(""))
    point = F.length(whole) + exponent
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits))))
    )
    short = F.when(F.contains(plain, F.lit(".")), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)
    signed = F.when(F.startswith(shown, F.lit("-")) & (short != "0"), F.concat(F.lit("-"), short)).otherwise(short)
    return F.when(body.rlike(r"^[0-9.]+$"), F.translate(signed, ".", ",")).otherwise(shown)
