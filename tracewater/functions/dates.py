"""Dates as the domain tables and export names write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dutch month names and their usual short forms.
DUTCH_MONTHS = {
    "januari": "1", "jan": "1",
    "februari": "2", "feb": "2",
    "maart": "3", "mrt": "3",
    "april": "4", "apr": "4",
    "mei": "5",
    "juni": "6", "jun": "6",
    "juli": "7", "jul": "7",
    "augustus": "8", "aug": "8",
    "september": "9", "sep": "9",
    "oktober": "10", "okt": "10",
    "november": "11", "nov": "11",
    "december": "12", "dec": "12",
}

# Day first, then year first; with and without a time of day.
_DAY_FIRST, _YEAR_FIRST, _TIME = r"\d{1,2}-\d{1,2}-\d{4}", r"\d{4}-\d{1,2}-\d{1,2}", r"-\d{1,2}-\d{1,2}-\d{1,2}"
_SHAPES = {
    _DAY_FIRST: "d-M-yyyy",
    _DAY_FIRST + _TIME: "d-M-yyyy-H-m-s",
    _YEAR_FIRST: "yyyy-M-d",
    _YEAR_FIRST + _TIME: "yyyy-M-d-H-m-s",
    r"\d{8}": "yyyyMMdd",
}

EXPORT_STAMP = r"\d{4}-\d{2}-\d{2}-\d{6}"


def parse_date(col: Column) -> Column:
    """Date from ``17 augustus 2023``, ``17-08-2023 10:00:00``, ``2023-08-17`` and the like; else null."""
    months = F.create_map(*[F.lit(x) for pair in DUTCH_MONTHS.items() for x in pair])
    tokens = F.regexp_extract_all(F.lower(col), F.lit(r"(\d+|\p{L}+)"), 1)
    plain = F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(months, t), t)), "-")

    def parsed(text: Column) -> Column:
        found = F.lit(None).cast("timestamp")
        for shape, form in _SHAPES.items():
            found = F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(form))).otherwise(found)
        return found.cast("date")

    # Through a one-element array, so that the tokens are made once per row
    # and not once per shape.
    return F.transform(F.array(plain), parsed)[0]


def export_time(path: Column) -> Column:
    """Timestamp ``yyyy-MM-dd-HHmmss`` inside an export's name; null without one."""
    stamp = F.regexp_extract(path, f"({EXPORT_STAMP})", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyy-MM-dd-HHmmss"))


def reporting_year(day: Column | None = None) -> Column:
    """The register runs two years behind."""
    return F.year(F.current_date() if day is None else day) - 2
