"""Outputs: folder per plant, stage tables, text reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.functions.text import comma_decimal
from tracewater.operators.parts import geometry_text
from tracewater.session import shared_folder

BOM = "﻿"


def write_per_value(df: DataFrame, path: str, column: str, fmt: str = "parquet", **options: object) -> None:
    """One folder per value of ``column``.

    The rebalance hint gathers a value's rows into few files, and still cuts a
    value that holds much of the data over several tasks.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).format(fmt).options(
        **options
    ).save(path)


def refresh_per_value(df: DataFrame, path: str, column: str) -> DataFrame:
    """Replace the folders of the values that ``df`` holds; all other values' files stay as they are.

    Returns the run's manifest, ``column`` and ``n_rows``, which is also
    written below ``_manifest``, a name that readers of ``path`` pass over. A
    value without rows in ``df`` is not refreshed. ``df`` is written to the
    shared folder first, so it may be read from ``path`` itself, and the
    manifest counts what was written.
    """
    rows = write_stage(df, shared_folder(df.sparkSession, "refresh"))
    writer = rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return write_stage(counts, f"{path.rstrip('/')}/_manifest/{uuid.uuid4().hex}")


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Hand-over between stages: write once, go on from the written table.

    This also cuts the lineage, so a lost executor costs a re-read only.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # stated, so that no job looks for it


def write_features(df: DataFrame, path: str, parts: str = "parts") -> None:
    """GeoJSON features, one per line: ``parts`` as geometry, all other columns as properties.

    Lines split over tasks when read (``scan_polygons(..., lines=True)``).
    Polygons without parts are written with a null geometry, null properties
    as null.
    """
    others = [c for c in df.columns if c != parts]
    properties = F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in others]), {"ignoreNullFields": "false"}) if others else F.lit("{}")
    line = F.concat(
        F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry_text(F.col(parts)), F.lit("null")),
        F.lit(',"properties":'), properties, F.lit("}"),
    )
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def with_display_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def write_comma_csv(df: DataFrame, path: str) -> None:
    """``;``-separated text with decimal commas and a byte order mark in front of each header."""
    shown = df.select(
        *[
            comma_decimal(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.FractionalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
    first = shown.columns[0]
    shown.withColumnRenamed(first, BOM + first).write.mode("overwrite").option("sep", ";").option(
        "header", True
    ).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str, run_date: dt.date | None = None, fmt: str = "csv") -> str:
    """Report of one run in its own ``run_date=`` folder; returns that folder."""
    day = run_date or dt.date.today()
    folder = f"{path.rstrip('/')}/run_date={day:%Y-%m-%d}"
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True).option("escape", '"') if fmt == "csv" else writer).save(folder)
    return folder
