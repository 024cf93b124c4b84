"""Sources and sinks on the test tables: each query writes a whole table to the shared folder and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tracewater.bindings.domain import AREA_SQL, CATCHMENT_SQL, CELL, areas, catchments
from tracewater.bindings.registry import query, table
from tracewater.functions.dates import DUTCH_MONTHS
from tracewater.operators import parts
from tracewater.operators.columns import valid_on
from tracewater.operators.spatial import with_box
from tracewater.session import shared_folder
from tracewater.sources import placed, readers, sinks
from tracewater.sources.schemas import struct


@query(
    "scan_files_provenance",
    """SELECT o_orderkey::VARCHAR AS o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
              CASE WHEN o_orderstatus <> 'P' THEN 'said "' || o_custkey || '"; twice' END AS note, o_orderstatus AS listed_in
       FROM orders""",
)
def scan_files_provenance(spark, sf):
    """Files in two column orders, one kind without notes, with separators, quotes and ``NA`` in cells."""
    folder = shared_folder(spark, "lists")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order  key"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("NA")).alias("Priority"),
        F.concat(F.lit('said "'), "o_custkey", F.lit('"; twice')).alias("Note"),
        F.col("o_orderstatus").alias("list"),
    )
    shapes = {"O": ["Order  key", "Priority", "Note"], "P": ["Order  key", "Priority"], "F": ["Note", "Priority", "Order  key"]}
    for status, columns in shapes.items():
        rows = orders.where(F.col("list") == status).select(columns)
        rows.write.csv(f"{folder}/list={status}", sep=";", header=True, escape='"')
    names = {"Order  key": "o_orderkey", "Priority": "priority", "Note": "note"}
    found = readers.scan_delimited(
        spark, folder, struct("o_orderkey priority note"), pattern="*.csv", sep=";", names=names, optional=["note"]
    )
    return readers.scan_with_name_part(found, "listed_in", "/list=([^/]+)/")


@query("scan_ragged_header", "SELECT c_custkey::VARCHAR AS cas, c_name AS name, c_acctbal AS score FROM customer")
def scan_ragged_header(spark, sf):
    folder = shared_folder(spark, "scores")
    table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CAS  RN"), F.col("c_name").alias("Name"), F.col("c_acctbal").alias("PMT-score"),
        F.lit(None).cast("string").alias("pad"),
    ).write.csv(folder, sep="\t", header=True)
    return readers.scan_delimited(spark, folder, struct("cas name score:d _pad"), file_column=None)


@query("scan_landed_sheet", "SELECT s_suppkey::VARCHAR AS code, s_name AS name, s_acctbal AS balance FROM supplier")
def scan_landed_sheet(spark, sf):
    """Sheets with two title lines above the header."""
    folder = shared_folder(spark, "sheets")
    line = F.concat_ws(";", F.col("s_suppkey").cast("string"), "s_name", F.col("s_acctbal").cast("string"))
    titles = "Bijlage\n\ncode;name;balance"
    writer = table(spark, sf, "supplier").select(line.alias(titles)).write
    writer.csv(folder, sep="\u0001", quote="\u0000", header=True)
    return readers.scan_landed(spark, folder, struct("code name balance:d"), preamble=2)


@query("latest_export", "SELECT o_orderkey, o_totalprice FROM orders")
def latest_export(spark, sf):
    folder = shared_folder(spark, "exports")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    older = orders.withColumn("o_totalprice", F.lit(0.0))
    orders.write.parquet(f"{folder}/Export_2024-03-01-101500")
    older.write.parquet(f"{folder}/Export_2024-02-28-235959")
    older.write.parquet(f"{folder}/Export_2024-13-41-000000")
    older.write.parquet(f"{folder}/Export_kopie")
    return readers.scan_newest_export(spark, folder, spark.read.parquet, "Export_*")


@query(
    "scan_partition_from_name",
    "SELECT c_custkey, c_acctbal, n_name AS plant FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def scan_partition_from_name(spark, sf):
    folder = shared_folder(spark, "plants")
    nation = table(spark, sf, "nation")
    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    named = customers.select("c_custkey", "c_acctbal", F.concat("n_name", F.lit("_ZZS")).alias("plant_file"))
    sinks.write_per_value(named, folder, "plant_file")
    found = spark.read.parquet(folder).select("c_custkey", "c_acctbal", F.col("_metadata.file_path").alias("file"))
    return readers.scan_with_name_part(found, "plant", "/plant_file=([^/]+)_ZZS/")


@query("paged_catalogue", "SELECT p_partkey::VARCHAR AS id, p_name AS name, p_type AS kind FROM part")
def paged_catalogue(spark, sf):
    """Pages that overlap: some rows come back on the next page too."""
    folder = shared_folder(spark, "pages")
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_size").alias("page")
    )
    again = part.where(F.col("kind") == "PROMO").withColumn("page", F.col("page") + 1)
    sinks.write_per_value(part.unionByName(again), folder, "page", "csv", sep=";", header=True)
    return readers.scan_pages(spark, folder, struct("id name kind"), ["id"])


@query(
    "domain_table",
    """SELECT o_orderkey::VARCHAR AS guid, o_custkey::VARCHAR AS id, CAST(o_orderdate AS DATE) AS begin_geldigheid,
              CAST(o_orderdate AS DATE) + 365 AS eind_geldigheid, o_orderpriority AS soort_stof FROM orders""",
)
def domain_table(spark, sf):
    folder = shared_folder(spark, "domain")
    day = F.col("o_orderdate").cast("date")
    months = F.array(*[F.lit(m) for m in DUTCH_MONTHS if len(m) > 3 or m == "mei"])
    written = F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.element_at(months, F.month(day)), F.year(day).cast("string"))
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("X1"), F.col("o_orderpriority").alias("Soort stof"), written.alias("Begin geldigheid"),
        F.date_format(F.date_add(day, 365), "dd-MM-yyyy").alias("Eind geldigheid"), F.col("o_custkey").alias("Id"),
    ).write.csv(folder, sep=";", header=True)
    return readers.scan_domain_table(spark, folder)


@query(
    "geojson_features",
    f"""SELECT postcode6, CASE WHEN postcode6 % 2 = 0 THEN 1 ELSE 2 END AS n_rings,
               ax - 15 AS min_x, ay - 15 AS min_y, ax + CASE WHEN postcode6 % 2 = 0 THEN 15 ELSE 115 END AS max_x,
               CAST(ay + 15 AS DOUBLE) AS max_y
        FROM (SELECT postcode6, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay FROM {AREA_SQL})""",
)
def geojson_features(spark, sf):
    """Odd areas have a second part 100 to the right; heights are dropped."""
    folder = shared_folder(spark, "features")

    def ring(r, dx=0):
        return F.transform(r, lambda p: F.array(p["x"] + dx, p["y"], F.lit(7.5)))

    first = ring(F.col("rings")[0])
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(first).alias("coordinates")))
    double = F.to_json(
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(first), F.array(ring(F.col("rings")[0], 100))).alias("coordinates"))
    )
    geometry = F.when(F.col("postcode6") % 2 == 0, single).otherwise(double)
    line = F.concat(
        F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), F.to_json(F.struct("postcode6")), F.lit("}")
    )
    areas(spark, sf).select(line.alias("value")).write.text(folder)
    found = readers.scan_polygons(spark, folder, {"postcode6": "bigint"}, lines=True)
    return with_box(found.withColumn("n_rings", F.size("rings")), "rings").drop("rings")


@query(
    "geojson_parts",
    f"""SELECT plant AS naam, CAST(CASE WHEN s_nationkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS part, 1 AS n_holes, CAST(x AS DOUBLE) AS min_x,
               50000.0::DOUBLE AS shell_area, -3600.0::DOUBLE AS hole_area FROM (SELECT s_nationkey, c.* FROM supplier JOIN {CATCHMENT_SQL} c ON s_name = plant)
        UNION ALL
        SELECT s_name, 0, 0, CAST(floor(s_acctbal) + 45 AS DOUBLE), CAST((s_nationkey + 2) * 10 AS DOUBLE), 0.0::DOUBLE FROM supplier WHERE s_nationkey % 2 = 0""",
)
def geojson_parts(spark, sf):
    """Catchments as flat ring lists, hole first and some with an island in it, written as features and read by parts."""
    folder = shared_folder(spark, "parts")
    island = table(spark, sf, "supplier").where("s_nationkey % 2 = 0").select(
        F.col("s_name").alias("naam"), F.floor("s_acctbal").alias("x"), (F.col("s_nationkey") * 400).alias("y"), (F.col("s_nationkey") + 2).alias("w")
    )
    corners = [(45, 45, 0), (45, 55, 0), (45, 55, 1), (45, 45, 1)]
    ring = F.array(*[
        F.struct((F.col("x") + dx + F.col("w") * right).cast("double").alias("x"), (F.col("y") + dy).cast("double").alias("y")) for dx, dy, right in corners
    ])
    flat = catchments(spark, sf).join(island.select("naam", ring.alias("island")), "naam", "left").select(
        "naam", F.filter(F.array(F.col("rings")[1], "island", F.reverse(F.col("rings")[0])), lambda r: r.isNotNull()).alias("rings")
    )
    sinks.write_features(parts.polygon_parts(flat, "naam", "rings", CELL), folder)
    found = readers.scan_polygons(spark, folder, {"naam": "string"}, lines=True, parts=True)
    each = found.select("naam", F.posexplode("parts").alias("part", "rings"))
    holes = F.transform(F.slice("rings", 2, F.size("rings")), parts.signed_area)
    return with_box(each, "rings").select(
        "naam", "part", (F.size("rings") - 1).alias("n_holes"), "min_x",
        parts.signed_area(F.col("rings")[0]).alias("shell_area"), F.aggregate(holes, F.lit(0.0), lambda s, a: s + a).alias("hole_area"),
    )


@query("geojson_collection", "SELECT postcode6, 1 AS n_rings, 1 AS first_ring FROM " + AREA_SQL)
def geojson_collection(spark, sf):
    """Feature collections of at most 1,000 features, one per file, landed as lines first."""
    folder = shared_folder(spark, "collections")
    ring = F.transform(F.col("rings")[0], lambda p: F.array(p["x"], p["y"]))
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"Polygon","coordinates":['), F.to_json(ring), F.lit(']},"properties":'),
        F.to_json(F.struct("postcode6")), F.lit("}"),
    )
    page = areas(spark, sf).select(feature.alias("f"), F.floor(F.col("postcode6") / 1000).alias("page")).groupBy("page")
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}"))
    page.agg(whole.alias("value")).select("value", "page").write.partitionBy("page").text(folder)
    lines = readers.land_features(spark, folder, shared_folder(spark, "features"))
    found = readers.scan_polygons(spark, lines, {"postcode6": "bigint"}, lines=True)
    closed = (F.size(F.col("rings")[0]) > 3).cast("int")
    return found.select("postcode6", F.size("rings").alias("n_rings"), closed.alias("first_ring"))


@query(
    "box_pruned_pages",
    f"""WITH b AS (SELECT min(x) AS x0, max(x) + 300 AS x1, min(y) AS y0, max(y) + 300 AS y1 FROM {CATCHMENT_SQL} WHERE s_acctbal > 9000)
        SELECT postcode6, 1 AS n_rings, CAST(ax - 15 AS DOUBLE) AS min_x, CAST(ay + 15 AS DOUBLE) AS max_y FROM {AREA_SQL}, b
        WHERE ax + 15 >= x0 AND ax - 15 <= x1 AND ay + 15 >= y0 AND ay - 15 <= y1""",
)
def box_pruned_pages(spark, sf):
    """Postcode areas landed by place; files that do not reach into the overall box of some catchments stay shut."""
    folder = shared_folder(spark, "placed")
    placed.land_by_place(with_box(areas(spark, sf), "rings"), folder, rows_per_file=500)
    rich = with_box(catchments(spark, sf).where(F.col("s_acctbal") > 9000), "rings")
    found = placed.features_in_box(spark, folder, rich)
    return found.select("postcode6", F.size("rings").alias("n_rings"), "min_x", "max_y")


@query(
    "domain_overview",
    """SELECT 'Lijst ' || o_orderkey AS domain_table, o_orderstatus AS kind, CAST(o_orderdate AS DATE) AS begin_geldigheid,
              CAST(o_orderdate AS DATE) + 365 AS eind_geldigheid, 2 + o_custkey % 2 AS n_columns, o_orderkey::VARCHAR AS guid
       FROM orders WHERE DATE '1996-06-30' BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 365""",
)
def domain_overview(spark, sf):
    """A list of domain tables, dates written out, and those of them that are valid on a day."""
    folder = shared_folder(spark, "overview")
    day = F.col("o_orderdate").cast("date")
    months = F.array(*[F.lit(m) for m in DUTCH_MONTHS if len(m) > 3 or m == "mei"])
    written = F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.element_at(months, F.month(day)), F.year(day).cast("string"))
    listed = F.when(F.col("o_custkey") % 2 == 0, "Id,Codes").otherwise("Id,Codes,Omschrijving")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("X1"), F.col("o_orderstatus").alias("Elementtype"), F.concat(F.lit("Lijst "), "o_orderkey").alias("Voorkeurslabel"),
        listed.alias("Metadata"), F.concat(written, F.lit(" 10:00:00")).alias("Wijzigingsdatum"), written.alias("Begin geldigheid"),
        F.date_format(F.date_add(day, 365), "dd-MM-yyyy").alias("Eind geldigheid"),
    ).write.csv(folder, sep=";", header=True)
    found = valid_on(readers.scan_domain_overview(spark, folder), dt.date(1996, 6, 30), "begin_geldigheid", "eind_geldigheid")
    return found.select(
        "domain_table", "kind", "begin_geldigheid", "eind_geldigheid", F.size("columns").cast("bigint").alias("n_columns"), "guid"
    )


@query("sink_partitioned", "SELECT o_orderkey, o_totalprice, o_orderpriority AS plant FROM orders")
def sink_partitioned(spark, sf):
    folder = shared_folder(spark, "sink")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("plant"))
    sinks.write_per_value(orders, folder, "plant")
    return spark.read.parquet(folder)


@query(
    "sink_refresh",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
              o_orderpriority AS plant FROM orders""",
)
def sink_refresh(spark, sf):
    """A later run replaces the folders of two plants, reading the old ones from the same path."""
    folder = shared_folder(spark, "refreshed")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("plant"))
    sinks.write_per_value(orders, folder, "plant")
    again = spark.read.parquet(folder).where(F.col("plant").isin("5-LOW", "1-URGENT"))
    sinks.refresh_per_value(again.withColumn("o_totalprice", F.col("o_totalprice") + 1), folder, "plant")
    return spark.read.parquet(folder)


@query(
    "locale_csv_sink",
    """SELECT c_custkey::VARCHAR AS id, regexp_replace(replace(c_acctbal::VARCHAR, '.', ','), ',0$', '') AS balance FROM customer""",
)
def locale_csv_sink(spark, sf):
    folder = shared_folder(spark, "comma")
    sinks.write_comma_csv(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")), folder
    )
    return readers.scan_delimited(spark, folder, struct("id balance"), sep=";", file_column=None)


@query("report_sink", """SELECT s_suppkey AS "CAS-nummer", s_name AS "Stofnaam", DATE '2024-05-01' AS run_date FROM supplier""")
def report_sink(spark, sf):
    folder = shared_folder(spark, "report")
    shown = sinks.with_display_names(
        table(spark, sf, "supplier").select("s_suppkey", "s_name"), {"s_suppkey": "CAS-nummer", "s_name": "Stofnaam"}
    )
    sinks.write_report(shown, folder, dt.date(2024, 5, 1), fmt="parquet")
    return spark.read.parquet(folder)


@query("stage_table", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL")
def stage_table(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return sinks.write_stage(counted, shared_folder(spark, "stage"))
