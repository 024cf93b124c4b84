"""Reports and company density on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewater.bindings import flows
from tracewater.bindings.domain import AREA_SQL, CATCHMENT_SQL, CELL, COMPOUND_SQL, MEETS_SQL, areas, catchments, chem, compounds
from tracewater.bindings.registry import QUERIES, SQL, query, table
from tracewater.operators.first import keep_first
from tracewater.operators.spatial import polygons_meeting
from tracewater.plans import checks, places, region, suspects


@query(
    "parameter_link_rate",
    f"""SELECT count(*) AS n_rows, count(codes) AS n_matched, count(*) - count(codes) AS n_unmatched,
               round(100.0 * count(codes) / count(*), 0) AS matched_pct,
               count(DISTINCT cas) + max(CASE WHEN cas IS NULL THEN 1 ELSE 0 END) AS n_cas
        FROM ({SQL['parameter_list']})""",
)
def parameter_link_rate(spark, sf):
    return checks.parameter_link_rate(QUERIES["parameter_list"](spark, sf))


@query(
    "unlinked_register",
    f"""SELECT DISTINCT register_code, register_name, parameter_code IS NULL AS without_code
        FROM ({SQL['emission_union']}) WHERE parameter_code IS NULL OR description IS NULL""",
)
def unlinked_register(spark, sf):
    return checks.unlinked_register(QUERIES["emission_union"](spark, sf))


@query(
    "register_sizes",
    """SELECT n_name AS plant, count(*) AS n_rows, count(DISTINCT (c_custkey, c_name)) AS n_companies
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def register_sizes(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    placed = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return checks.register_sizes(
        placed.select(F.col("n_name").alias("plant"), F.col("c_custkey").alias("nic"), F.col("c_name").alias("company"))
    )


@query(
    "postcode_sizes",
    f"""SELECT plant, count(DISTINCT postcode6) AS n_postcodes, count(DISTINCT substr(postcode6::VARCHAR, 1, 4)) AS n_areas
        FROM {CATCHMENT_SQL}, {AREA_SQL} WHERE {MEETS_SQL} GROUP BY plant""",
)
def postcode_sizes(spark, sf):
    pairs = polygons_meeting(areas(spark, sf), "rings", ["postcode6"], catchments(spark, sf), "rings", ["naam"], CELL)
    return checks.postcode_sizes(pairs.withColumnRenamed("naam", "plant"), distinct=True)


@query(
    "suspects_summary",
    """SELECT count(*) AS n_rows, count(cas) AS n_matched, count(*) - count(cas) AS n_unmatched,
              round(100.0 * count(cas) / count(*), 1) AS matched_pct,
              count(DISTINCT cas) + max(CASE WHEN cas IS NULL THEN 1 ELSE 0 END) AS n_cas, count(DISTINCT plant) AS n_plant
       FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN 'C-' || l_partkey END AS cas, l_suppkey AS plant FROM lineitem)""",
)
def suspects_summary(spark, sf):
    cas = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("C-"), F.col("l_partkey").cast("string")))
    return checks.suspects_summary(table(spark, sf, "lineitem").select(cas.alias("cas"), F.col("l_suppkey").alias("plant")))


@query(
    "without_compound",
    f"""SELECT DISTINCT s.cas, s.substance FROM ({flows.NAVIGATOR_SQL}) s WHERE s.cas IS NOT NULL
        AND s.cas NOT IN (SELECT cas FROM ({COMPOUND_SQL}) WHERE cid IS NOT NULL AND title NOT LIKE 'T%3')""",
)
def without_compound(spark, sf):
    known = compounds(spark, sf).where(~F.col("title").like("T%3"))
    return checks.without_compound(flows.navigator(spark, sf), known)


_FOUND_SQL = f"""SELECT cas, smiles, formula, cid FROM ({COMPOUND_SQL})
    QUALIFY row_number() OVER (PARTITION BY cas ORDER BY cid::BIGINT NULLS LAST, title) = 1"""


def _found(spark, sf):
    return keep_first(compounds(spark, sf), ["cas"], [F.col("cid").cast("bigint").asc_nulls_last(), "title"])


@query(
    "smiles_losses",
    f"""WITH f AS ({_FOUND_SQL}), k AS (SELECT count(DISTINCT smiles) + max(CASE WHEN smiles IS NULL THEN 1 ELSE 0 END) AS kept, count(*) AS n FROM f)
        SELECT n AS n_cas, n - kept AS n_lost, round(100.0 * (n - kept) / n, 1) AS lost_pct FROM k""",
)
def smiles_losses(spark, sf):
    return checks.smiles_losses(_found(spark, sf))


@query(
    "class_totals",
    f"SELECT chemical_class, count(*) AS n FROM ({SQL['classify_rules']}) GROUP BY 1",
)
def class_totals(spark, sf):
    return checks.class_totals(suspects.classify(chem(spark, sf).withColumn("cid", F.col("p_partkey"))))


_GEO_SQL = """SELECT c_custkey, 4.5 + c_nationkey * 0.08::DOUBLE + c_acctbal / 40000 AS lon, 51.5 + (c_custkey % 97) / 97.0::DOUBLE AS lat
    FROM customer WHERE c_acctbal > 0"""
_KM = 5000.0


@query(
    "company_density",
    f"""WITH {flows.COUNTS_CTE},
      each AS (SELECT c_custkey, n_name AS plant, {flows.NATION_CODE} AS code FROM customer JOIN nation ON c_nationkey = n_nationkey
               UNION ALL SELECT c_custkey, n_name, {flows.OWN_CODE} FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING'),
      geo AS ({_GEO_SQL}),
      d AS (SELECT c_custkey, 0.36::DOUBLE * (lat - 52.15517440) AS p, 0.36::DOUBLE * (lon - 5.38720621) AS q FROM geo),
      rd AS (SELECT c_custkey,
         155000 + (190094.945*q - 11832.228*p*q - 114.221*p*p*q - 32.391*q*q*q - 0.705*p - 2.340*p*p*p*q
                   - 0.608*p*q*q*q - 0.008*q*q + 0.148*p*p*q*q*q) AS x,
         463000 + (309056.544*p + 3638.893*q*q + 73.077*p*p - 157.984*p*q*q + 59.788*p*p*p + 0.433*q
                   - 6.439*p*p*q*q - 0.032*p*q + 0.092*q*q*q*q - 0.054*p*q*q*q*q) AS y FROM d),
      pt AS (SELECT e.plant, rd.x, rd.y FROM each e JOIN sel ON e.code = sel.plain AND sel.process IS NOT NULL JOIN rd USING (c_custkey)),
      n AS (SELECT plant, count(*) AS total FROM pt GROUP BY 1),
      s AS (SELECT *, unnest(generate_series(ceil((x - 4 * {_KM}::DOUBLE) / {_KM})::BIGINT, floor((x + 4 * {_KM}::DOUBLE) / {_KM})::BIGINT)) AS ix FROM pt),
      c AS (SELECT *, unnest(generate_series(ceil((y - 4 * {_KM}::DOUBLE) / {_KM})::BIGINT, floor((y + 4 * {_KM}::DOUBLE) / {_KM})::BIGINT)) AS iy FROM s),
      k AS (SELECT plant, ix, iy, sum(exp(-(pow((ix * {_KM}::DOUBLE - x) / {_KM}::DOUBLE, 2) + pow((iy * {_KM}::DOUBLE - y) / {_KM}::DOUBLE, 2)) / 2)
                / (2 * pi() * {_KM}::DOUBLE * {_KM}::DOUBLE)) AS t FROM c GROUP BY ALL),
      g AS (SELECT plant, ix, iy, round(t / total * 1e6, 9) AS density FROM k JOIN n USING (plant)),
      spots AS (SELECT pt.plant, g.density FROM pt JOIN g ON g.plant = pt.plant AND g.ix = floor(pt.x / {_KM} + 0.5) AND g.iy = floor(pt.y / {_KM} + 0.5)),
      l AS (SELECT plant, quantile_cont(density, 0.9) AS b10, quantile_cont(density, 0.75) AS b25, quantile_cont(density, 0.5) AS b50,
                   quantile_cont(density, 0.25) AS b75, quantile_cont(density, 0.1) AS b90 FROM spots GROUP BY 1)
      SELECT plant, ix, iy, density, CAST(CASE WHEN density >= b10 THEN 10 WHEN density >= b25 THEN 25 WHEN density >= b50 THEN 50
             WHEN density >= b75 THEN 75 WHEN density >= b90 THEN 90 END AS INTEGER) AS band FROM g JOIN l USING (plant)""",
)
def company_density(spark, sf):
    addressed = region.company_addresses(flows.companies(spark, sf), flows.selection(spark, sf))
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customers = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    address = F.concat_ws(", ", "c_mktsegment", F.col("c_custkey").cast("string"), "n_name", F.lit("Netherlands"))
    register = customers.select(
        address.alias("address"),
        (F.lit(51.5) + (F.col("c_custkey") % 97) / F.lit(97.0)).alias("latitude"),
        (F.lit(4.5) + F.col("c_nationkey") * F.lit(0.08) + F.col("c_acctbal") / 40000).alias("longitude"),
    )
    return places.company_density(addressed, register, (_KM, _KM), (_KM, _KM))
