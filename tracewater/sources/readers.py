"""Folder scans: one read per folder, provenance from the file path."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.functions.dates import EXPORT_STAMP, export_time, parse_date
from tracewater.functions.text import null_if_na
from tracewater.operators.columns import domain_header, rename_all
from tracewater.operators.first import keep_first
from tracewater.session import shared_folder


def scan_delimited(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    sep: str = "\t",
    file_column: str | None = "file",
    header: bool = True,
    names: Mapping[str, str] | None = None,
    optional: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """All delimited files of a folder as one frame, with the source path in ``file_column``.

    With ``names`` (header text to column, as in ``schemas.HEADERS``) columns
    are found by each file's own header, in any order; a header without a
    column of ``schema`` is an error, but for ``optional`` ones, which are then
    null. Without ``names`` columns go by position, for files whose headers are
    ragged. Quotes inside quoted cells are doubled. ``NA`` and empty cells are
    null; padding columns (leading underscore) are dropped. ``multi_line`` allows
    line breaks in cells, at the cost of one task per file.
    """
    if names is not None:
        headers, raw = _by_header(spark, folder, sep, pattern, multi_line)
        places = [{names.get(title, title): cell for title, cell in found.items()} for found in headers]
        wanted = [f for f in schema.fields if not f.name.startswith("_")]
        for found, place in zip(headers, places, strict=True):
            absent = {f.name for f in wanted if f.name not in place} - set(optional)
            if absent:
                raise ValueError(f"no column for {sorted(absent)} in header {list(found)}")
        cells = [_cell(_placed([place.get(f.name) for place in places]), f) for f in wanted]
        return raw.select(*([F.col("__file").alias(file_column)] if file_column else []), *cells)
    reader = _csv(spark, sep, pattern, multi_line).schema(schema).option("header", header)
    raw = reader.csv(folder)
    cells = [
        null_if_na(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
        if not f.name.startswith("_")
    ]
    origin = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
    return raw.select(*origin, *cells)


def _csv(spark: SparkSession, sep: str, pattern: str | None = None, multi_line: bool = False):
    reader = spark.read.option("sep", sep).option("encoding", "UTF-8").option("escape", '"').option("multiLine", multi_line)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _cell(text: Column, field: T.StructField) -> Column:
    filled = null_if_na(text.cast("string"))
    return (filled if isinstance(field.dataType, T.StringType) else filled.try_cast(field.dataType)).alias(field.name)


def _first_lines(spark: SparkSession, folder: str, n: int, pattern: str | None = None) -> DataFrame:
    """``path, line, value``: the first ``n`` lines of each file, without a byte order mark.

    Where files are ordinary ones (``file:``), tasks open each path of Spark's
    own listing and read no further than those lines. Other stores are read by
    Spark alone, and there all lines pass through the scan.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    origin = F.col("_metadata.file_path").alias("path")
    if _scheme(spark, folder) == "file":
        paths = reader.format("binaryFile").load(folder).select(origin, F.col("path").alias("opened"))
        return paths.mapInPandas(_openers(n), "path string, line int, value string")
    lines = reader.text(folder).select(origin, F.col("_metadata.file_block_start").alias("start"), "value")
    head = lines.where(F.col("start") == 0).withColumn("place", F.monotonically_increasing_id())
    line = F.row_number().over(Window.partitionBy("path").orderBy("place"))
    return head.withColumn("line", line).where(F.col("line") <= n).select("path", "line", F.regexp_replace("value", "^\ufeff", "").alias("value"))


def _scheme(spark: SparkSession, folder: str) -> str:
    """The kind of store that a path leads to."""
    return urlparse(folder).scheme or urlparse(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme


def _openers(n: int):
    """The task function of ``_first_lines``; it travels by value, so executors need no copy of this module."""

    def first_lines(frames):
        import bz2
        import gzip
        from itertools import islice

        import pandas as pd

        packed = {"gz": gzip.open, "bz2": bz2.open}
        for frame in frames:
            rows = []
            for path, opened in zip(frame["path"], frame["opened"], strict=True):
                opener = packed.get(opened.rpartition(".")[2], open)
                with opener(opened.removeprefix("file:"), "rt", encoding="utf-8-sig", errors="replace") as lines:
                    rows += [(path, i, text.rstrip("\n")) for i, text in enumerate(islice(lines, n), 1)]
            yield pd.DataFrame(rows, columns=["path", "line", "value"])

    return first_lines


def _by_header(
    spark: SparkSession, folder: str, sep: str, pattern: str | None = None, multi_line: bool = False
) -> tuple[list[dict[str, str]], DataFrame]:
    """The different headers, title to column, the commonest first; all rows as text, with ``__file`` and ``__header``, their header's number.

    The folder is one scan however many headers there are, and the driver gets
    one line per different header, no paths. Only files with another header
    than the commonest are joined by path; which way, Spark decides by their
    size. The first lines are written to the shared folder, read once.
    """
    staged = shared_folder(spark, "headers")
    _first_lines(spark, folder, 1, pattern).select("path", "value").write.parquet(staged)
    heads = spark.read.schema("path string, value string").parquet(staged)
    counted = heads.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
    lines = [row["value"] for row in counted.collect()]
    if not lines:
        raise FileNotFoundError(f"no file with a header in {folder}")
    headers: list[dict[str, str]] = []
    width = 0
    for line in lines:
        titles = next(csv.reader([line], delimiter=sep), [])
        width = max(width, len(titles))
        headers.append({})
        for i, title in enumerate(titles):
            headers[-1].setdefault(title.strip() or "X1", f"__c{i}")  # the first one without a title goes by this name
    schema = T.StructType([T.StructField(f"__c{i}", T.StringType()) for i in range(width)])
    raw = _csv(spark, sep, pattern, multi_line).schema(schema).option("header", True).csv(folder)
    rows = raw.select(F.col("_metadata.file_path").alias("__file"), *schema.names)
    if len(lines) == 1:
        return headers, rows.withColumn("__header", F.lit(0))
    number = F.array_position(F.array(*[F.lit(line) for line in lines]), F.col("value")).cast("int") - 1
    others = heads.where(F.col("value") != lines[0]).select(F.col("path").alias("__file"), number.alias("__other"))
    return headers, rows.join(others, "__file", "left").withColumn("__header", F.coalesce("__other", F.lit(0))).drop("__other")


def _placed(cells: Sequence[str | None]) -> Column:
    """The cell of a column that stands in ``cells[i]`` under header ``i``; null where it is None."""
    if len(set(cells)) == 1:
        return F.lit(None) if cells[0] is None else F.col(cells[0])
    return reduce(
        lambda out, i: out.when(F.col("__header") == i, F.col(cells[i])),
        [i for i, c in enumerate(cells) if c is not None],
        F.when(F.lit(False), F.lit(None)),
    )


def scan_landed(
    spark: SparkSession, folder: str, schema: T.StructType, sep: str = ";", preamble: int = 0
) -> DataFrame:
    """A workbook sheet landed as delimited text, with ``preamble`` title lines above its header.

    The title lines and the header are taken from each file's first block and
    dropped from a read that splits over tasks, wherever a line equals one of
    them. Cells must not contain line breaks.
    """
    if not preamble:
        return scan_delimited(spark, folder, schema, sep=sep, file_column=None)
    titles = _first_lines(spark, folder, preamble + 1).select("path", "value")
    lines = spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^\ufeff", "").alias("value")
    )
    body = lines.where(F.col("value") != "").join(titles, ["path", "value"], "left_anti")
    row = F.from_csv("value", _ddl(schema), {"sep": sep, "escape": '"'})
    return body.select(row.alias("r")).select(
        *[
            (null_if_na(F.col("r")[f.name]) if isinstance(f.dataType, T.StringType) else F.col("r")[f.name]).alias(f.name)
            for f in schema.fields
            if not f.name.startswith("_")
        ]
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def scan_with_name_part(
    df: DataFrame, out: str, pattern: str, file_column: str = "file"
) -> DataFrame:
    """Add the part of the file path that ``pattern``'s group matches, such as the plant's name."""
    part = F.regexp_extract(F.col(file_column), pattern, 1)
    return df.withColumn(out, F.nullif(F.url_decode(part), F.lit(""))).drop(file_column)


def newest_export(spark: SparkSession, folder: str, pattern: str = "*") -> str:
    """Path of the export with the latest timestamp in its name.

    Only paths are read, no content. An export may be a file or a folder of
    part files. Names without a valid timestamp are ignored.
    """
    paths = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    )
    export = paths.select(F.regexp_extract("path", rf"^(.*/[^/]*{EXPORT_STAMP}[^/]*)", 1).alias("export"))
    glob = "^" + pattern.replace(".", r"\.").replace("*", ".*") + "$"
    stamped = export.where(F.regexp_extract("export", "([^/]*)$", 1).rlike(glob)).select(
        "export", export_time(F.col("export")).alias("at")
    )
    row = stamped.where(F.col("at").isNotNull()).agg(F.max_by("export", "at").alias("export")).head()
    if row is None or row["export"] is None:
        raise FileNotFoundError(f"no dated export like {pattern} in {folder}")
    return row["export"]


def scan_newest_export(spark: SparkSession, folder: str, read: Callable[[str], DataFrame], pattern: str = "*") -> DataFrame:
    return read(newest_export(spark, folder, pattern))


def scan_pages(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    keys: list[str],
    sep: str = ";",
    names: Mapping[str, str] | None = None,
    page: str = r"page\D?(\d+)",
) -> DataFrame:
    """Landed pages of a paged service as one table; a row on two pages is kept once.

    Of repeated ids the row of the first page stays: by the number that
    ``page``'s group finds in the path, then by path.
    """
    rows = scan_delimited(spark, folder, schema, sep=sep, names={} if names is None else names)
    number = F.nullif(F.regexp_extract("file", page, 1), F.lit("")).try_cast("bigint")
    payload = [F.col(c) for c in rows.columns if c != "file" and c not in keys]
    return keep_first(rows, keys, [number, "file", *payload]).drop("file")


def _titled(spark: SparkSession, folder: str, sep: str) -> DataFrame:
    """All files by their own headers; a column that a file lacks is null there."""
    headers, raw = _by_header(spark, folder, sep)
    titles = list(dict.fromkeys(title for found in headers for title in found))
    return raw.select([_placed([found.get(title) for found in headers]).cast("string").alias(title) for title in titles])


def scan_domain_table(spark: SparkSession, folder: str, sep: str = ";") -> DataFrame:
    """A landed domain table: header rule, dates in any known form, known columns first."""
    table = rename_all(_titled(spark, folder, sep), domain_header)
    dates = [c for c in table.columns if "geldigheid" in c or "datum" in c]
    table = table.withColumns({c: parse_date(F.col(c)) for c in dates})
    # The columns that domain tables share.
    lead = ["id", "codes", "cijfercode", "omschrijving", "begin_geldigheid", "eind_geldigheid"]
    known = [c for c in lead if c in table.columns]
    return table.select(*known, *[c for c in table.columns if c not in known])


def scan_domain_overview(spark: SparkSession, folder: str, sep: str = ";") -> DataFrame:
    """A landed list of domain tables: name, kind, dates, its columns as an array, guid."""
    table = rename_all(_titled(spark, folder, sep), domain_header)
    day = {c: parse_date(F.col(c)) for c in ("wijzigingsdatum", "begin_geldigheid", "eind_geldigheid")}
    return table.select(
        F.col("voorkeurslabel").alias("domain_table"), F.col("elementtype").alias("kind"),
        *[value.alias(name) for name, value in day.items()],
        F.split("metadata", ",").alias("columns"), "guid",
    )


def scan_polygons(spark: SparkSession, folder: str, properties: dict[str, str], lines: bool = False, parts: bool = False) -> DataFrame:
    """GeoJSON polygons and multipolygons, one row per feature with a ``rings`` column.

    ``properties`` maps property names to types. A third coordinate is
    dropped. ``lines`` reads one feature per line, which splits over tasks;
    otherwise each file is one feature collection, as map services deliver it.
    ``parts`` adds a column with the same rings by part, each its shell first.
    """
    props = ", ".join(f"`{n}`: {t}" for n, t in properties.items())
    geometry, record = "struct<type: string, coordinates: string>", f"struct<{props}>"
    if lines:
        features = spark.read.schema(f"geometry {geometry}, properties {record}").json(folder)
    else:
        pages = spark.read.option("multiLine", True).schema(
            f"features array<struct<geometry: {geometry}, properties: {record}>>"
        ).json(folder)
        features = pages.select(F.explode("features").alias("f")).select("f.*")
    return features.select(
        *[F.col("properties")[n].alias(n) for n in properties],
        rings_from_coordinates(F.col("geometry.type"), F.col("geometry.coordinates")).alias("rings"),
        *[parts_from_coordinates(F.col("geometry.type"), F.col("geometry.coordinates")).alias("parts")][: int(parts)],
    )


def land_features(spark: SparkSession, folder: str, out: str) -> str:
    """Feature collections, as map services deliver them, to one feature per line in ``out``.

    A collection is one JSON value, so one task reads each file; the lines
    written here split over tasks (``scan_polygons(..., lines=True)``).
    """
    feature = "struct<geometry: struct<type: string, coordinates: string>, properties: string>"
    pages = spark.read.option("multiLine", True).schema(f"features array<{feature}>").json(folder)
    f = pages.select(F.explode("features").alias("f")).select("f.*")
    geometry = F.concat(
        F.lit('{"type":"'), F.col("geometry.type"), F.lit('","coordinates":'), F.col("geometry.coordinates"), F.lit("}")
    )
    line = F.concat(F.lit('{"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit(',"properties":'), F.coalesce("properties", F.lit("null")), F.lit("}"))
    f.select(line.alias("value")).write.text(out)
    return out


def rings_from_coordinates(kind: Column, coordinates: Column) -> Column:
    """Coordinate text of a polygon or multipolygon to rings of ``x, y``."""
    return F.flatten(parts_from_coordinates(kind, coordinates))


def parts_from_coordinates(kind: Column, coordinates: Column) -> Column:
    """Coordinate text of a polygon or multipolygon to parts, each its shell first and then its holes."""
    single = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    several = F.from_json(coordinates, "array<array<array<array<double>>>>")
    parts = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", several)

    def point(p: Column) -> Column:
        return F.struct(p[0].alias("x"), p[1].alias("y"))

    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, point)))
