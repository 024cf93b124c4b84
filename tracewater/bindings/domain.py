"""Loads, chemical class, compounds, places and density on the test tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tracewater.bindings.registry import query, table
from tracewater.functions.chemistry import Rule, chemical_class
from tracewater.functions.elements import class_by_elements, formula_elements, smiles_elements
from tracewater.functions.geodesy import to_rd, to_wgs84
from tracewater.operators import bandwidth, contours, density, overlay, spatial
from tracewater.operators.rows import repeated_keys
from tracewater.plans import emission, places, suspects
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage


@query(
    "annual_load",
    """SELECT event_id, user_id AS plant_code, round(value * 365 / 1000000, 8) AS load FROM events
       WHERE event_type <> 'view' AND value > 0 AND user_id <> 0""",
)
def annual_load(spark, sf):
    measured = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", emission.ALL).alias("year"),
        F.when(F.col("user_id") == 0, emission.ALL).otherwise(F.col("user_id").cast("string")).alias("plant_code"),
        F.col("value").alias("median"),
    )
    return emission.yearly_loads(measured, digits=8).select("event_id", F.col("plant_code").cast("bigint"), "load")


# -- chemistry: a formula and a SMILES text from a part's type, size and name ----

_FRAGMENTS = {
    "red": "CC", "blue": "c1ccccc1", "old": "[Na+].CC", "hot": "C[Hg]C", "new": "CBr", "small": "[Fe]C",
    "large": "CB(O)O", "cold": "C[Pb]", "green": "CN", "ring": "O", "bolt": "Cl", "widget": "N", "plate": "S",
    "rod": "Sn", "gear": "C#N", "nut": "F",
}
_FRAGMENT_SQL = "CASE {0} " + " ".join(f"WHEN '{w}' THEN '{f}'" for w, f in _FRAGMENTS.items()) + " END"
_CHEM_SQL = f"""SELECT p_partkey, p_size, p_type,
    CASE p_type WHEN 'PROMO' THEN 'NaCl' WHEN 'SMALL' THEN NULL WHEN 'LARGE' THEN 'CHCl3'
                ELSE 'C' || p_size || 'H' || (2 * p_size) END AS formula,
    {_FRAGMENT_SQL.format("split_part(p_name, ' ', 1)")} || {_FRAGMENT_SQL.format("split_part(p_name, ' ', 2)")} AS smiles
    FROM part"""
_CLASS_SQL = r"""CASE WHEN formula IS NULL THEN NULL
    WHEN NOT regexp_matches(formula, 'C[1-9]') THEN 'Inorganic'
    WHEN smiles IS NULL THEN NULL
    WHEN contains(smiles, '.') THEN 'Organic Ionic'
    WHEN regexp_matches(smiles, 'C[adenorus]|S[bceni]|Pb|Hg|[AKMYLG]|N[a-z]|B[^r]') THEN 'Organometallic'
    ELSE 'Organic' END"""


def chem(spark, sf):
    fragments = F.create_map(*[F.lit(x) for pair in _FRAGMENTS.items() for x in pair])
    words = F.split("p_name", " ")
    kind, size = F.col("p_type"), F.col("p_size")
    formula = (
        F.when(kind == "PROMO", "NaCl")
        .when(kind == "LARGE", "CHCl3")
        .when(kind != "SMALL", F.concat(F.lit("C"), size.cast("string"), F.lit("H"), (2 * size).cast("string")))
    )
    smiles = F.concat(F.try_element_at(fragments, words[0]), F.try_element_at(fragments, words[1]))
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_type", formula.alias("formula"), smiles.alias("smiles"))


@query(
    "classify_rules",
    f"SELECT p_partkey, formula, smiles, {_CLASS_SQL} AS chemical_class FROM ({_CHEM_SQL}) WHERE {_CLASS_SQL} IS NOT NULL",
)
def classify_rules(spark, sf):
    classified = chem(spark, sf).withColumn("chemical_class", chemical_class(F.col("formula"), F.col("smiles")))
    return classified.where(F.col("chemical_class").isNotNull()).select("p_partkey", "formula", "smiles", "chemical_class")


@query(
    "classify_text",
    r"""SELECT doc_id, CASE WHEN NOT regexp_matches(source, '[1-9]') THEN 'Inorganic'
             WHEN contains(text, '%%%') THEN 'Organic Ionic'
             WHEN regexp_matches(text, 'C[adenorus]') THEN 'Organometallic' ELSE 'Organic' END AS chemical_class
        FROM documents""",
)
def classify_text(spark, sf):
    """A user's own rule list over whole texts."""
    rules = [
        Rule("Inorganic", "formula", "[1-9]", absent=True),
        Rule("Organic Ionic", "smiles", "%%%"),
        Rule("Organometallic", "smiles", "C[adenorus]"),
    ]
    return table(spark, sf, "documents").select(
        "doc_id", chemical_class(F.col("source"), F.col("text"), rules).alias("chemical_class")
    )


# Two compounds per CAS number; some without an id, some sharing a SMILES text.
COMPOUND_SQL = f"""SELECT 'C-' || (p_partkey // 2) AS cas,
      CASE WHEN p_size <> 7 THEN (p_partkey + 10)::VARCHAR END AS cid, formula,
      ' ' || smiles || CASE WHEN p_size > 25 THEN '' ELSE repeat('C', p_size) END AS smiles,
      'T' || p_partkey AS title, p_size * 1.5 AS mass, p_size % 3 AS charge
    FROM ({_CHEM_SQL})"""
_ENRICHED_SQL = """wanted AS (SELECT DISTINCT 'C-' || (l_partkey // 3) AS cas FROM lineitem),
    named AS (SELECT c.* FROM compounds c WHERE cid IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY cas ORDER BY cid::BIGINT) = 1),
    enriched AS (SELECT n.* REPLACE (trim(smiles) AS smiles) FROM named n JOIN wanted USING (cas)
              QUALIFY row_number() OVER (PARTITION BY trim(smiles) ORDER BY n.cas) = 1)"""


def compounds(spark, sf):
    size = F.col("p_size")
    return chem(spark, sf).select(
        F.concat(F.lit("C-"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("cas"),
        F.when(size != 7, (F.col("p_partkey") + 10).cast("string")).alias("cid"),
        "formula",
        F.concat(F.lit(" "), "smiles", F.when(size > 25, "").otherwise(F.repeat(F.lit("C"), size))).alias("smiles"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("title"),
        (size * F.lit(1.5)).alias("mass"),
        (size % 3).alias("charge"),
    )


@query(
    "compound_enrich",
    f"""WITH compounds AS ({COMPOUND_SQL}), {_ENRICHED_SQL}
        SELECT cas, cid, formula, smiles, title, CAST(mass AS DOUBLE) AS mass, charge FROM enriched""",
)
def compound_enrich(spark, sf):
    wanted = table(spark, sf, "lineitem").select(
        F.concat(F.lit("C-"), F.floor(F.col("l_partkey") / 3).cast("string")).alias("cas")
    )
    return suspects.enrich_compounds(wanted, compounds(spark, sf))


@query(
    "compound_duplicates",
    f"SELECT cas, count(*) AS n FROM ({COMPOUND_SQL}) WHERE cid IS NOT NULL GROUP BY cas HAVING count(*) > 1",
)
def compound_duplicates(spark, sf):
    """Substances that the compound service knows under several ids."""
    return repeated_keys(compounds(spark, sf).where(F.col("cid").isNotNull()), "cas")


# -- places --------------------------------------------------------------------

_ADDRESS_SQL = """SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey,
                         c_name || ', ' || c_mktsegment || ', Netherlands' AS address FROM customer"""


@query(
    "address_coordinates",
    f"""WITH a AS ({_ADDRESS_SQL}),
        known AS (SELECT upper(address) AS k, 50 + c_nationkey / 10 AS latitude, c_acctbal / 1000 AS longitude FROM a WHERE c_acctbal > 0
                  UNION ALL SELECT upper(n_name), 52 + n_nationkey / 100, 5.5 FROM nation),
        o AS (SELECT *, CASE WHEN c_acctbal <= 0 AND c_mktsegment = 'BUILDING' THEN 'NATION_' || c_nationkey ELSE upper(address) END AS k FROM a)
        SELECT c_custkey, address, latitude, longitude FROM o LEFT JOIN known USING (k)""",
)
def address_coordinates(spark, sf):
    text = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(", Netherlands"))
    customers = table(spark, sf, "customer").withColumn("address", text)
    nation = table(spark, sf, "nation").select(
        F.col("n_name").alias("address"), (52 + F.col("n_nationkey") / 100).alias("latitude"), F.lit(5.5).alias("longitude")
    )
    register = customers.where(F.col("c_acctbal") > 0).select(
        F.concat(F.lit(" "), F.replace(F.upper("address"), F.lit(", "), F.lit(" ,  "))).alias("address"),
        (50 + F.col("c_nationkey") / 10).alias("latitude"),
        (F.col("c_acctbal") / 1000).alias("longitude"),
    )
    overrides = customers.where((F.col("c_acctbal") <= 0) & (F.col("c_mktsegment") == "BUILDING")).select(
        "address", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("corrected")
    )
    return places.locate(customers.select("c_custkey", "address"), register.unionByName(nation), overrides)


@query(
    "location_report",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (c_acctbal > 0) AS n_matched,
               count(*) FILTER (c_acctbal <= 0) AS n_unmatched,
               round(100.0 * count(*) FILTER (c_acctbal > 0) / count(*), 1) AS matched_pct,
               count(DISTINCT address) AS n_address FROM ({_ADDRESS_SQL})""",
)
def location_report(spark, sf):
    text = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(", Netherlands"))
    customers = table(spark, sf, "customer").select("c_acctbal", text.alias("address"))
    register = customers.where(F.col("c_acctbal") > 0).select(
        "address", F.lit(52.0).alias("latitude"), F.lit(5.0).alias("longitude")
    )
    return places.location_report(places.locate(customers, register))


@query(
    "crs_transform",
    """WITH g AS (SELECT o_orderkey, 3.5 + o_totalprice / 500000 * 3.5 AS lon, 50.8 + dayofyear(o_orderdate) / 366.0::DOUBLE * 2.6 AS lat FROM orders),
       d AS (SELECT *, 0.36::DOUBLE * (lat - 52.15517440) AS p, 0.36::DOUBLE * (lon - 5.38720621) AS q FROM g),
       r AS (SELECT *,
         155000 + (190094.945*q - 11832.228*p*q - 114.221*p*p*q - 32.391*q*q*q - 0.705*p - 2.340*p*p*p*q
                   - 0.608*p*q*q*q - 0.008*q*q + 0.148*p*p*q*q*q) AS x,
         463000 + (309056.544*p + 3638.893*q*q + 73.077*p*p - 157.984*p*q*q + 59.788*p*p*p + 0.433*q
                   - 6.439*p*p*q*q - 0.032*p*q + 0.092*q*q*q*q - 0.054*p*q*q*q*q) AS y FROM d),
       b AS (SELECT *, (x - 155000) * 1e-5 AS u, (y - 463000) * 1e-5 AS v FROM r)
       SELECT o_orderkey, round(x, 3) AS rd_x, round(y, 3) AS rd_y,
         round(5.38720621 + (5260.52916*u + 105.94684*u*v + 2.45656*u*v*v - 0.81885*u*u*u + 0.05594*u*v*v*v - 0.05607*u*u*u*v
               + 0.01199*v - 0.00256*u*u*u*v*v + 0.00128*u*v*v*v*v + 0.00022*v*v - 0.00022*u*u + 0.00026*u*u*u*u*u) / 3600, 7) AS lon_back,
         round(52.15517440 + (3235.65389*v - 32.58297*u*u - 0.24750*v*v - 0.84978*u*u*v - 0.06550*v*v*v - 0.01709*u*u*v*v
               - 0.00738*u + 0.00530*u*u*u*u - 0.00039*u*u*v*v*v + 0.00033*u*u*u*u*v - 0.00012*u*v) / 3600, 7) AS lat_back
       FROM b""",
)
def crs_transform(spark, sf):
    placed = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.lit(3.5) + F.col("o_totalprice") / 500000 * 3.5).alias("longitude"),
        (F.lit(50.8) + F.dayofyear("o_orderdate") / F.lit(366.0) * 2.6).alias("latitude"),
    )
    x, y = to_rd(F.col("longitude"), F.col("latitude"))
    moved = placed.withColumns({"x": x, "y": y})
    lon, lat = to_wgs84(F.col("x"), F.col("y"))
    return moved.select(
        "o_orderkey", F.round("x", 3).alias("rd_x"), F.round("y", 3).alias("rd_y"),
        F.round(lon, 7).alias("lon_back"), F.round(lat, 7).alias("lat_back"),
    )


# Catchments: one L-shaped ring with a square hole in its corner per supplier.
# Postcode areas: one square per customer. Points: one per order. All corners
# are whole numbers, so touching cases occur and are exact.
CATCHMENT_SQL = "(SELECT s_name AS plant, s_acctbal, floor(s_acctbal) AS x, s_nationkey * 400 AS y FROM supplier)"
AREA_SQL = """(SELECT c_custkey AS postcode6, floor(c_acctbal) AS ax,
                      c_nationkey * 400 + abs(floor(c_acctbal)::BIGINT * 7) % 400 AS ay FROM customer)"""
POINT_SQL = """(SELECT o_orderkey, floor(o_totalprice / 50) AS px,
                       4 * (CAST(o_orderdate AS DATE) - DATE '1995-01-01') AS py FROM orders)"""
MEETS_SQL = """((ax + 15 >= x AND ax - 15 <= x + 300 AND ay + 15 >= y AND ay - 15 <= y + 100)
      OR (ax + 15 >= x AND ax - 15 <= x + 100 AND ay + 15 >= y AND ay - 15 <= y + 300))
     AND NOT (ax - 15 > x + 20 AND ax + 15 < x + 80 AND ay - 15 > y + 20 AND ay + 15 < y + 80)"""
COVERS_SQL = """((px BETWEEN x AND x + 300 AND py BETWEEN y AND y + 100)
      OR (px BETWEEN x AND x + 100 AND py BETWEEN y AND y + 300))
     AND NOT (px > x + 20 AND px < x + 80 AND py > y + 20 AND py < y + 80)"""
CELL = 250.0


def _ring(x, y, corners):
    return F.array(*[F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y")) for dx, dy in corners])


_L_SHAPE = [(0, 0), (300, 0), (300, 100), (100, 100), (100, 300), (0, 300), (0, 0)]
_HOLE = [(20, 20), (80, 20), (80, 80), (20, 80), (20, 20)]
_SQUARE = [(-15, -15), (15, -15), (15, 15), (-15, 15), (-15, -15)]


def catchments(spark, sf):
    x, y = F.floor("s_acctbal"), F.col("s_nationkey") * 400
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("naam"), "s_acctbal", F.array(_ring(x, y, _L_SHAPE), _ring(x, y, _HOLE)).alias("rings")
    )


def areas(spark, sf):
    x = F.floor("c_acctbal")
    y = F.col("c_nationkey") * 400 + F.abs(x * 7) % 400
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("postcode6"), F.array(_ring(x, y, _SQUARE)).alias("rings"))


def points(spark, sf):
    days = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 50).cast("double").alias("px"), (days * 4).cast("double").alias("py")
    )


@query(
    "spatial_join_intersects",
    f"SELECT DISTINCT plant AS naam, postcode6 FROM {CATCHMENT_SQL}, {AREA_SQL} WHERE {MEETS_SQL}",
)
def spatial_join_intersects(spark, sf):
    return spatial.polygons_meeting(
        areas(spark, sf), "rings", ["postcode6"], catchments(spark, sf), "rings", ["naam"], CELL
    )


def _overlap_sql(x0, x1, y0, y1):
    """Common area of an area's square and a box of the catchment's frame."""
    return f"""(greatest(least(ax + 15, x + {x1}) - greatest(ax - 15, x + {x0}), 0)
                * greatest(least(ay + 15, y + {y1}) - greatest(ay - 15, y + {y0}), 0))"""


@query(
    "catchment_overlap",
    f"""WITH o AS (SELECT DISTINCT plant AS naam, s_acctbal, postcode6, ax, ay,
                      {_overlap_sql(0, 300, 0, 100)} + {_overlap_sql(0, 100, 100, 300)} - {_overlap_sql(20, 80, 20, 80)} AS common
               FROM {CATCHMENT_SQL}, {AREA_SQL})
        SELECT naam, postcode6, round(CAST(common AS DOUBLE), 6) AS area, round(common / 900.0::DOUBLE, 9) AS share FROM o WHERE common > 0""",
)
def catchment_overlap(spark, sf):
    """How much of each postcode area a catchment holds: pairs that only touch are left out."""
    found = overlay.polygon_overlaps(
        areas(spark, sf), "rings", ["postcode6"], catchments(spark, sf), "rings", ["naam"], CELL
    )
    return found.select("naam", "postcode6", F.round("area", 6).alias("area"), F.round("share", 9).alias("share"))


@query(
    "point_in_polygon",
    f"SELECT o_orderkey, plant AS naam FROM {POINT_SQL}, {CATCHMENT_SQL} WHERE {COVERS_SQL}",
)
def point_in_polygon(spark, sf):
    found = spatial.points_in_polygons(points(spark, sf), "px", "py", catchments(spark, sf), "rings", ["naam"], CELL)
    return found.select("o_orderkey", "naam")


@query(
    "bbox_prefilter",
    f"""WITH b AS (SELECT min(x) AS x0, max(x) + 300 AS x1, min(y) AS y0, max(y) + 300 AS y1
                   FROM {CATCHMENT_SQL} WHERE s_acctbal > 9000)
        SELECT o_orderkey, CAST(px AS DOUBLE) AS px, CAST(py AS DOUBLE) AS py FROM {POINT_SQL}, b
        WHERE px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1""",
)
def bbox_prefilter(spark, sf):
    rich = catchments(spark, sf).where(F.col("s_acctbal") > 9000)
    return spatial.within_box(points(spark, sf), "px", "py", spatial.with_box(rich, "rings"))


_STEP, _BANDWIDTH = (1.0, 20.0), (1.5, 20.0)
_KDE_SQL = f"""p AS (SELECT event_type, CAST(hour(ts) AS DOUBLE) AS x, value AS y FROM events),
    n AS (SELECT event_type, count(*) AS total FROM p GROUP BY 1),
    s AS (SELECT event_type, x, y, unnest(generate_series(ceil(x - 6.0)::BIGINT, floor(x + 6.0)::BIGINT)) AS ix FROM p),
    c AS (SELECT *, unnest(generate_series(ceil((y - 80.0) / 20)::BIGINT, floor((y + 80.0) / 20)::BIGINT)) AS iy FROM s),
    k AS (SELECT event_type, ix, iy, sum(exp(-(pow((ix - x) / 1.5::DOUBLE, 2) + pow((iy * 20 - y) / 20.0::DOUBLE, 2)) / 2)
                 / ({2 * math.pi!r}::DOUBLE * 1.5::DOUBLE * 20.0::DOUBLE)) AS total_kernel FROM c GROUP BY ALL),
    g AS (SELECT event_type, ix, iy, round(total_kernel / total, 12) AS density FROM k JOIN n USING (event_type))"""


def _event_points(spark, sf):
    return table(spark, sf, "events").select(
        "event_type", F.hour("ts").cast("double").alias("x"), F.col("value").alias("y")
    )


def _event_density(spark, sf):
    grid = density.kernel_density(_event_points(spark, sf), ["event_type"], "x", "y", _STEP, _BANDWIDTH)
    return grid.withColumn("density", F.round("density", 12))


@query("kde_grid", f"WITH {_KDE_SQL} SELECT event_type, ix, iy, round(density, 9) AS density FROM g")
def kde_grid(spark, sf):
    return _event_density(spark, sf).withColumn("density", F.round("density", 9))


@query(
    "kde_normal_scale",
    """WITH p AS (SELECT event_type, CAST(hour(ts) AS DOUBLE) AS x, value AS y FROM events),
        b AS (SELECT event_type, count(*) AS total, stddev_samp(x) * pow(count(*), -1.0::DOUBLE / 6) AS hx,
                     stddev_samp(y) * pow(count(*), -1.0::DOUBLE / 6) AS hy FROM p GROUP BY 1),
        s AS (SELECT *, unnest(generate_series(ceil(x - 4 * hx)::BIGINT, floor(x + 4 * hx)::BIGINT)) AS ix FROM p JOIN b USING (event_type)),
        c AS (SELECT *, unnest(generate_series(ceil((y - 4 * hy) / 20)::BIGINT, floor((y + 4 * hy) / 20)::BIGINT)) AS iy FROM s)
        SELECT event_type, ix, iy, round(sum(exp(-(pow((ix - x) / hx, 2) + pow((iy * 20 - y) / hy, 2)) / 2) / (2 * pi() * hx * hy)) / any_value(total), 9) AS density
        FROM c GROUP BY event_type, ix, iy""",
)
def kde_normal_scale(spark, sf):
    """Each group with the bandwidth that its own spread and size suggest."""
    points = _event_points(spark, sf)
    chosen = density.normal_scale_bandwidth(points, ["event_type"], "x", "y")
    grid = density.kernel_density(points, ["event_type"], "x", "y", _STEP, chosen)
    return grid.withColumn("density", F.round("density", 9))


@query(
    "hdr_bands",
    f"""WITH {_KDE_SQL},
        spots AS (SELECT p.event_type, g.density FROM p JOIN g ON g.event_type = p.event_type
                 AND g.ix = floor(p.x + 0.5) AND g.iy = floor(p.y / 20 + 0.5)),
        q AS (SELECT event_type, quantile_cont(density, 0.9) AS b10, quantile_cont(density, 0.75) AS b25,
                     quantile_cont(density, 0.5) AS b50, quantile_cont(density, 0.25) AS b75,
                     quantile_cont(density, 0.1) AS b90 FROM spots GROUP BY 1)
        SELECT event_type, ix, iy, round(density, 9) AS density,
               CAST(CASE WHEN density >= b10 THEN 10 WHEN density >= b25 THEN 25 WHEN density >= b50 THEN 50
                         WHEN density >= b75 THEN 75 WHEN density >= b90 THEN 90 END AS INTEGER) AS band
        FROM g JOIN q USING (event_type)""",
)
def hdr_bands(spark, sf):
    bands = density.density_bands(
        _event_points(spark, sf), _event_density(spark, sf), ["event_type"], "x", "y", _STEP
    )
    return bands.withColumn("density", F.round("density", 9))


# Sides as whole numbers: lower node and direction; the cells below, beside and across share them.
_SIDE_SQL = "((({dy} + iy) * 1000000 + ix + {dx}) * 2 + {d})"
_B, _R = _SIDE_SQL.format(dy=0, dx=0, d=0), _SIDE_SQL.format(dy=0, dx=1, d=1)
_T, _L = _SIDE_SQL.format(dy=1, dx=0, d=0), _SIDE_SQL.format(dy=0, dx=0, d=1)
_CONTOUR_SQL = f"""{_KDE_SQL},
    spots AS (SELECT p.event_type, g.density FROM p JOIN g ON g.event_type = p.event_type
              AND g.ix = floor(p.x + 0.5) AND g.iy = floor(p.y / 20 + 0.5)),
    levels AS (SELECT event_type, 50 AS band, quantile_cont(density, 0.5) AS level FROM spots GROUP BY 1
               UNION ALL SELECT event_type, 90, quantile_cont(density, 0.1) FROM spots GROUP BY 1),
    cells AS (SELECT event_type, ix - dx AS ix, iy - dy AS iy,
                     coalesce(max(density) FILTER (dx = 0 AND dy = 0), 0) AS v0, coalesce(max(density) FILTER (dx = 1 AND dy = 0), 0) AS v1,
                     coalesce(max(density) FILTER (dx = 1 AND dy = 1), 0) AS v2, coalesce(max(density) FILTER (dx = 0 AND dy = 1), 0) AS v3
              FROM g, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) c(dx, dy) GROUP BY ALL),
    sides AS (SELECT *, v0 >= level AS i0, v1 >= level AS i1, v2 >= level AS i2, v3 >= level AS i3, (v0 + v1 + v2 + v3) / 4 >= level AS mid,
                     {_B} AS sb, {_R} AS sr, {_T} AS st, {_L} AS sl,
                     {{'x': ix + (level - v0) / (v1 - v0), 'y': 20 * iy}} AS pb, {{'x': ix + 1, 'y': 20 * (iy + (level - v1) / (v2 - v1))}} AS pr,
                     {{'x': ix + (level - v3) / (v2 - v3), 'y': 20 * (iy + 1)}} AS pt, {{'x': ix, 'y': 20 * (iy + (level - v0) / (v3 - v0))}} AS pl
              FROM cells JOIN levels USING (event_type)),
    coded AS (SELECT *, i0::INT + 2 * i1::INT + 4 * i2::INT + 8 * i3::INT AS code FROM sides),
    segs AS (
      SELECT event_type, band, sb AS a, sl AS b, pb AS p, pl AS q FROM coded WHERE code = 1 OR code = 5 AND NOT mid UNION ALL
      SELECT event_type, band, sr, sb, pr, pb FROM coded WHERE code = 2 OR code = 10 AND NOT mid UNION ALL
      SELECT event_type, band, st, sr, pt, pr FROM coded WHERE code = 4 OR code = 5 AND NOT mid UNION ALL
      SELECT event_type, band, sl, st, pl, pt FROM coded WHERE code = 8 OR code = 10 AND NOT mid UNION ALL
      SELECT event_type, band, sr, sl, pr, pl FROM coded WHERE code = 3 UNION ALL
      SELECT event_type, band, st, sb, pt, pb FROM coded WHERE code = 6 UNION ALL
      SELECT event_type, band, sl, sr, pl, pr FROM coded WHERE code = 12 UNION ALL
      SELECT event_type, band, sb, st, pb, pt FROM coded WHERE code = 9 UNION ALL
      SELECT event_type, band, st, sl, pt, pl FROM coded WHERE code = 7 OR code = 5 AND mid UNION ALL
      SELECT event_type, band, sl, sb, pl, pb FROM coded WHERE code = 14 OR code = 10 AND mid UNION ALL
      SELECT event_type, band, sb, sr, pb, pr FROM coded WHERE code = 13 OR code = 5 AND mid UNION ALL
      SELECT event_type, band, sr, st, pr, pt FROM coded WHERE code = 11 OR code = 10 AND mid),
    walk AS (SELECT event_type, band, a AS root, a, b, 1 AS n, p.x * q.y - q.x * p.y AS twice FROM segs UNION ALL
             SELECT w.event_type, w.band, root, s.a, s.b, n + 1, twice + (s.p.x * s.q.y - s.q.x * s.p.y)
             FROM walk w JOIN segs s ON s.event_type = w.event_type AND s.band = w.band AND s.a = w.b WHERE w.b > root)"""


@query(
    "density_contours",
    f"""WITH RECURSIVE {_CONTOUR_SQL}
        SELECT event_type, band, CAST(root AS BIGINT) AS ring, CAST(n AS BIGINT) AS n_points, round(twice / 2, 5) AS area
        FROM walk WHERE b = root""",
)
def density_contours(spark, sf):
    """The outlines of the regions that hold half and nine tenths of each group's points; holes have negative areas."""
    grid = write_stage(_event_density(spark, sf), shared_folder(spark, "density"))
    levels = density.band_levels(_event_points(spark, sf), grid, ["event_type"], "x", "y", _STEP, (50, 90))
    found = contours.contour_segments(grid, ["event_type"], "density", levels, _STEP)
    rings = contours.ring_summary(contours.ring_points(found, ["event_type"]), ["event_type"])
    number = (F.col("ring.iy") * 1000000 + F.col("ring.ix")) * 2 + F.col("ring.d")
    return rings.select("event_type", "band", number.alias("ring"), "n_points", F.round("area", 5).alias("area"))


@query("kde_plug_in")
def kde_plug_in(spark, sf):
    """Each group with the plug-in bandwidth matrix; its search has no SQL, so a test compares it with double sums."""
    points = _event_points(spark, sf)
    chosen = write_stage(bandwidth.plug_in_bandwidth(points, ["event_type"], "x", "y"), shared_folder(spark, "bandwidth"))
    grid = bandwidth.matrix_density(points, ["event_type"], "x", "y", _STEP, chosen)
    return grid.withColumn("density", F.round("density", 9))


_NONMETAL_SQL = "['H', 'D', 'T', 'He', 'C', 'N', 'O', 'F', 'Ne', 'P', 'S', 'Cl', 'Ar', 'Br', 'Kr', 'I', 'Xe']"
_ELEMENT_SQL = f"""WITH c AS ({_CHEM_SQL}),
    m AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'K' || p_size || '[Fe(CN)' || (p_size % 7 + 2) || ']2.3H2O' ELSE formula END AS formula, smiles,
                 p_size % 3 = 0 AS grouped, p_size AS k, p_size % 7 + 2 AS cn FROM c),
    f AS (SELECT *, CASE WHEN grouped THEN ['K', 'Fe', 'C', 'N', 'H', 'O'] ELSE regexp_extract_all(formula, '[A-Z][a-z]?') END AS fe,
                 regexp_extract_all(smiles, '\\[([A-Z][a-z]?)[^\\]]*\\]|Cl|Br|[BCNOPSFIbcnops]') AS raw FROM m),
    s AS (SELECT *, list_transform(raw, lambda t: CASE WHEN t LIKE '[%' THEN regexp_extract(t, '[A-Z][a-z]?') ELSE upper(t[1]) || t[2:] END) AS se FROM f)
    SELECT p_partkey, formula, smiles,
           CASE WHEN formula IS NULL THEN NULL WHEN NOT list_contains(fe, 'C') THEN 'Inorganic' WHEN smiles IS NULL THEN NULL
                WHEN contains(smiles, '.') THEN 'Organic Ionic'
                WHEN len(list_filter(list_concat(fe, se), lambda e: NOT list_contains({_NONMETAL_SQL}, e))) > 0 THEN 'Organometallic'
                ELSE 'Organic' END AS chemical_class,
           CAST(CASE WHEN grouped THEN k + 2 * (1 + 2 * cn) + 9
                     ELSE list_sum(list_transform(regexp_extract_all(formula, '[A-Z][a-z]?([0-9]*)', 1), lambda n: CASE n WHEN '' THEN 1 ELSE n::BIGINT END)) END AS BIGINT) AS n_atoms,
           CAST(len(list_filter(se, lambda e: e = 'C')) AS BIGINT) AS smiles_carbons
    FROM s"""


@query("classify_elements", _ELEMENT_SQL)
def classify_elements(spark, sf):
    """Classes by parsed elements; a third of the formulas are made of nested groups and a hydrate."""
    grouped = F.concat(F.lit("K"), "p_size", F.lit("[Fe(CN)"), F.col("p_size") % 7 + 2, F.lit("]2.3H2O"))
    formula, smiles = F.col("formula"), F.col("smiles")
    atoms = F.aggregate(F.map_values(formula_elements(formula)), F.lit(0).cast("bigint"), lambda n, c: n + c)
    carbons = F.coalesce(F.try_element_at(smiles_elements(smiles), F.lit("C")), F.when(smiles.isNotNull(), F.lit(0).cast("bigint")))
    return chem(spark, sf).withColumn("formula", F.when(F.col("p_size") % 3 == 0, grouped).otherwise(formula)).select(
        "p_partkey", "formula", "smiles", class_by_elements(formula, smiles).alias("chemical_class"),
        atoms.alias("n_atoms"), carbons.alias("smiles_carbons"),
    )


@query(
    "address_suggestions",
    """WITH r AS (SELECT DISTINCT upper(c_name) || ', ' || c_mktsegment AS known FROM customer WHERE c_acctbal > 0),
            m AS (SELECT DISTINCT upper(replace(c_name, 'omer', 'omr')) || ', ' || c_mktsegment AS address FROM customer WHERE c_acctbal <= 0),
            d AS (SELECT address, known AS suggestion, levenshtein(address, known) AS distance FROM m, r WHERE levenshtein(address, known) <= 2)
       SELECT address, suggestion, CAST(distance AS INTEGER) AS distance,
              CAST(row_number() OVER (PARTITION BY address ORDER BY distance, suggestion) AS INTEGER) AS rank,
              row_number() OVER (PARTITION BY address ORDER BY distance, suggestion) = 1
                AND count(*) OVER (PARTITION BY address, distance) = 1 AS only
       FROM d""",
)
def address_suggestions(spark, sf):
    """Names with a letter missing, of customers who are not in the register, so the nearest ones differ in a digit."""
    customers = table(spark, sf, "customer").select("c_acctbal", "c_name", F.concat("c_name", F.lit(" ,  "), "c_mktsegment").alias("address"))
    register = customers.where(F.col("c_acctbal") > 0).select("address", F.lit(52.0).alias("latitude"), F.lit(5.0).alias("longitude"))
    wrong = customers.where(F.col("c_acctbal") <= 0).select(F.replace("address", F.lit("omer"), F.lit("omr")).alias("address"))
    return places.address_suggestions(places.locate(wrong, register), register, edits=2)
