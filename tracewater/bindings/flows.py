"""The four flows end to end, with the test tables in the roles of their inputs.

part lists substances, supplier holds activities and selected codes, customer
the companies, nation the plants, orders the emission register and events the
measurements. Everything is derived from whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewater.bindings.domain import (
    AREA_SQL, CATCHMENT_SQL, CELL, COMPOUND_SQL, MEETS_SQL, areas, catchments, compounds,
)
from tracewater.bindings.registry import query, table
from tracewater.plans import bridge, emission, places, region, run, suspects
from tracewater.session import shared_folder
from tracewater.sources.sinks import write_stage

_STATUS_LABELS = {"Emissie verwacht": "expected", "Emissie mogelijk": "possible"}

# -- roles ---------------------------------------------------------------------

# Names, sub-branches and codes are cut so that each meets a bounded number of
# rows on the other side: the flows grow linearly with the tables.
_SUBSTANCE_SQL = "split_part(p_name, ' ', 2) || ' ' || (p_partkey // 8)"
NAVIGATOR_SQL = f"""SELECT CASE WHEN p_type = 'PROMO' THEN 'Individuele stoffen' ELSE 'ZZS ' || p_type END AS substance_group,
      CASE WHEN p_name <> 'red plate' THEN {_SUBSTANCE_SQL} END AS substance,
      CASE WHEN p_size < 45 THEN 'C-' || (p_partkey // 4) END AS cas, 'D' || n_regionkey AS division,
      CASE WHEN p_size % 5 <> 0 THEN p_brand END AS branch, CASE WHEN p_size <= 40 THEN 'S' || (p_partkey // 500) END AS sub_branch,
      'Water' AS compartment,
      CASE WHEN p_size <= 5 THEN 'Emissie verwacht' WHEN p_size = 6 THEN 'Gebruik verwacht' ELSE 'Emissie mogelijk' END AS emission_status
    FROM part JOIN nation ON p_brand = 'Brand#' || (n_nationkey + 1)"""
NAMES_SQL = f"""SELECT {_SUBSTANCE_SQL} AS name_nl, upper({_SUBSTANCE_SQL}) AS name_uk,
      CASE WHEN p_size < 45 THEN 'C-' || (p_partkey // 4) END AS cas, min('EC-' || p_size) AS ec_nr, min('S-' || p_name) AS smiles
    FROM part WHERE p_type <> 'SMALL' GROUP BY ALL"""
PMT_SQL = """SELECT 'C-' || (p_partkey // 4) AS cas, max(p_name) AS pmt_name, max(p_size) / 50 AS pmt_score, max(p_brand) AS pmt_class
    FROM part WHERE p_size >= 20 GROUP BY 1"""
_CODE_SQL = "CASE WHEN s_suppkey < 10 THEN '0' || s_suppkey ELSE s_suppkey::VARCHAR END"
ACTIVITY_SQL = """SELECT 'D' || n_regionkey AS division, CASE WHEN s_acctbal > 2000 THEN 'Brand#' || (n_nationkey + 1) END AS branch,
      CASE WHEN s_suppkey >= 25 THEN 'S' || (s_suppkey // 25) END AS sub_branch,
      CASE WHEN s_acctbal >= 0 THEN s_suppkey::VARCHAR END AS code, s_name AS code_name, 'A' || s_suppkey AS activity_nr
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
SELECTION_SQL = f"""SELECT left({_CODE_SQL}, 2) || '.' || substr({_CODE_SQL}, 3) AS code_decimal,
      CASE WHEN s_acctbal >= 1000 THEN 'P' || s_suppkey END AS process, n_name AS main_group
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
PARAMETERS_SQL = """SELECT 'C-' || (p_partkey // 4) AS casnummer, min(p_partkey)::VARCHAR AS id, 'P' || min(p_partkey) AS codes,
      min(p_name) AS omschrijving FROM part WHERE p_type <> 'LARGE' GROUP BY 1"""


def _part_cas():
    return F.concat(F.lit("C-"), F.floor(F.col("p_partkey") / 4).cast("string"))


def _substance():
    return F.concat(F.split("p_name", " ")[1], F.lit(" "), F.floor(F.col("p_partkey") / 8).cast("string"))


def navigator(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 1).cast("string")).alias("p_brand"),
        F.concat(F.lit("D"), F.col("n_regionkey").cast("string")).alias("division"),
    )
    size = F.col("p_size")
    return table(spark, sf, "part").join(nation, "p_brand").select(
        F.when(F.col("p_type") == "PROMO", suspects.SINGLE_SUBSTANCES).otherwise(F.concat(F.lit("ZZS "), "p_type")).alias("substance_group"),
        F.when(F.col("p_name") != "red plate", _substance()).alias("substance"),
        F.when(size < 45, _part_cas()).alias("cas"),
        "division",
        F.when(size % 5 != 0, F.col("p_brand")).alias("branch"),
        F.when(size <= 40, F.concat(F.lit("S"), F.floor(F.col("p_partkey") / 500).cast("string"))).alias("sub_branch"),
        F.lit("Water").alias("compartment"),
        F.when(size <= 5, "Emissie verwacht").when(size == 6, "Gebruik verwacht").otherwise("Emissie mogelijk").alias("emission_status"),
    )


def names(spark, sf):
    listed = table(spark, sf, "part").where(F.col("p_type") != "SMALL").select(
        _substance().alias("name_nl"), F.upper(_substance()).alias("name_uk"),
        F.when(F.col("p_size") < 45, _part_cas()).alias("cas"), "p_size", "p_name",
    )
    return listed.groupBy("name_nl", "name_uk", "cas").agg(
        F.min(F.concat(F.lit("EC-"), F.col("p_size").cast("string"))).alias("ec_nr"),
        F.min(F.concat(F.lit("S-"), "p_name")).alias("smiles"),
    )


def pmt(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size") >= 20).groupBy(_part_cas().alias("cas")).agg(
        F.max("p_name").alias("pmt_name"), (F.max("p_size") / 50).alias("pmt_score"), F.max("p_brand").alias("pmt_class")
    )


def _with_nation(spark, sf):
    return table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )


def _two_digits(key):
    return F.when(key < 10, F.concat(F.lit("0"), key.cast("string"))).otherwise(key.cast("string"))


def activity(spark, sf):
    key = F.col("s_suppkey").cast("string")
    return _with_nation(spark, sf).select(
        F.concat(F.lit("D"), F.col("n_regionkey").cast("string")).alias("division"),
        F.when(F.col("s_acctbal") > 2000, F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 1).cast("string"))).alias("branch"),
        F.when(F.col("s_suppkey") >= 25, F.concat(F.lit("S"), F.floor(F.col("s_suppkey") / 25).cast("string"))).alias("sub_branch"),
        F.when(F.col("s_acctbal") >= 0, key).alias("code"),
        F.col("s_name").alias("code_name"), F.concat(F.lit("A"), key).alias("activity_nr"),
    )


def selection(spark, sf):
    code = _two_digits(F.col("s_suppkey"))
    return _with_nation(spark, sf).select(
        F.concat(F.left(code, F.lit(2)), F.lit("."), F.substr(code, F.lit(3))).alias("code_decimal"),
        F.when(F.col("s_acctbal") >= 1000, F.concat(F.lit("P"), F.col("s_suppkey").cast("string"))).alias("process"),
        F.col("n_name").alias("main_group"),
    )


def companies(spark, sf):
    """Codes: the nation's number and, outside one segment, the customer's; sectors run parallel."""
    nation = table(spark, sf, "nation")
    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    single = F.col("c_mktsegment") == "BUILDING"
    own = _two_digits(F.floor(F.col("c_custkey") / 15))
    return customers.select(
        F.col("n_name").alias("plant"),
        F.when(single, _two_digits(F.col("c_nationkey"))).otherwise(
            F.concat(_two_digits(F.col("c_nationkey")), F.lit(", "), own)
        ).alias("codes"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("machines | parts")).otherwise(F.col("c_mktsegment")).alias("sectors"),
        F.col("c_mktsegment").alias("street"), F.col("c_custkey").cast("string").alias("postcode"), F.col("n_name").alias("town"),
    )


def parameters(spark, sf):
    return table(spark, sf, "part").where(F.col("p_type") != "LARGE").groupBy(_part_cas().alias("casnummer")).agg(
        F.min("p_partkey").cast("string").alias("id"),
        F.concat(F.lit("P"), F.min("p_partkey").cast("string")).alias("codes"),
        F.min("p_name").alias("omschrijving"),
    )


def register(spark, sf):
    """Orders as register rows of the customer's nation; some codes carry decimals or are no number."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_custkey").cast("string")
    code = F.when(F.col("o_orderstatus") == "F", F.concat(key, F.lit(".7"))).when(
        F.col("o_orderpriority") == "5-LOW", "onbekend"
    ).otherwise(key)
    return orders.select(
        F.col("n_name").alias("plant"), code.alias("substance_code"), F.col("c_mktsegment").alias("substance_name"),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("company"),
        F.col("o_orderstatus").alias("code_name"), F.col("o_totalprice").alias("emission"), F.lit("kg").alias("unit"),
        F.year("o_orderdate").alias("year"), F.lit("register").alias("origin"), F.col("o_orderpriority").alias("dataset"),
    )


def register_codes(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("int").alias("register_code"), F.col("c_mktsegment").alias("register_name"),
        F.concat(F.lit("P"), (F.col("c_custkey") * 4).cast("string")).alias("parameter_code"),
    )


def measurements(spark, sf):
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        F.when(F.col("event_type") == "view", "2020").otherwise(emission.ALL).alias("year"),
        F.when(user == 0, emission.ALL).otherwise(user.cast("string")).alias("plant_code"),
        F.when(user != 3, F.concat(F.lit("NATION-zuid "), (user % 25).cast("string"))).alias("location"),
        F.concat(F.lit("P"), (user * 8).cast("string")).alias("parameter_code"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("substance_name"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("C-"), user.cast("string"))).alias("cas"),
        F.regexp_extract("props", r"(\d+)", 1).alias("register_code"),
        F.col("value").alias("median"),
    )


# -- SQL of each flow ------------------------------------------------------------

_BRIDGE_CTE = f"""
  nav AS ({NAVIGATOR_SQL}), names AS ({NAMES_SQL}), pmt AS ({PMT_SQL}), act AS ({ACTIVITY_SQL}),
  named AS (SELECT * FROM nav WHERE substance IS NOT NULL),
  lone AS (SELECT division, substance_group, substance, cas FROM named WHERE branch IS NULL
           EXCEPT SELECT division, substance_group, substance, cas FROM named WHERE branch IS NOT NULL),
  added AS (SELECT * FROM named n WHERE division IN (SELECT division FROM lone)
              AND substance_group IN (SELECT substance_group FROM lone) AND substance IN (SELECT substance FROM lone)
              AND EXISTS (SELECT 1 FROM lone WHERE lone.cas IS NOT DISTINCT FROM n.cas)),
  listing AS (SELECT * FROM named WHERE branch IS NOT NULL UNION SELECT * FROM added),
  w AS (SELECT *, length(code) AS digits FROM act),
  coded AS (SELECT * EXCLUDE (code, digits), code AS code_written,
              CASE digits WHEN 1 THEN '0' || code WHEN 3 THEN left(code, 2) || '.' || right(code, 1) ELSE code END AS code_decimal,
              CASE digits WHEN 1 THEN '0' || code ELSE code END AS code_plain,
              rpad(CASE digits WHEN 1 THEN '0' || code ELSE code END, 5, '0') AS code_padded FROM w WHERE code IS NOT NULL),
  props AS (SELECT names.*, pmt_name, pmt_score, pmt_class FROM names LEFT JOIN pmt ON names.cas = pmt.cas),
  bridge AS (SELECT c.code_plain, c.code_padded, c.code_written, c.code_decimal, c.code_name, c.activity_nr,
                    l.division, l.branch, l.sub_branch, l.substance_group, l.substance, l.cas,
                    p.name_nl, p.name_uk, p.ec_nr, p.smiles, l.emission_status, l.compartment, p.pmt_name, p.pmt_score, p.pmt_class
             FROM listing l JOIN coded c ON l.division IS NOT DISTINCT FROM c.division
                AND l.branch IS NOT DISTINCT FROM c.branch AND l.sub_branch IS NOT DISTINCT FROM c.sub_branch
             LEFT JOIN props p ON l.substance IS NOT DISTINCT FROM p.name_nl AND l.cas IS NOT DISTINCT FROM p.cas)"""

OWN_CODE = "CASE WHEN c_custkey // 15 < 10 THEN '0' || (c_custkey // 15) ELSE (c_custkey // 15)::VARCHAR END"
NATION_CODE = "CASE WHEN c_nationkey < 10 THEN '0' || c_nationkey ELSE c_nationkey::VARCHAR END"
COUNTS_CTE = f"""
  company AS (SELECT n_name AS plant, {NATION_CODE} AS code FROM customer JOIN nation ON c_nationkey = n_nationkey
              UNION ALL SELECT n_name, {OWN_CODE} FROM customer JOIN nation ON c_nationkey = n_nationkey
              WHERE c_mktsegment <> 'BUILDING' OR c_mktsegment = 'MACHINERY'),
  sel AS (SELECT *, replace(code_decimal, '.', '') AS plain FROM ({SELECTION_SQL})),
  counts AS (SELECT plant, code, count(*) AS n FROM company GROUP BY ALL),
  chosen AS (SELECT plant, code, n, main_group FROM counts JOIN sel ON code = plain WHERE process IS NOT NULL)"""

_DETAIL = "substance, cas, name_nl, name_uk, ec_nr, smiles, emission_status, compartment, pmt_name, pmt_score, pmt_class"
_IDS = "substance, cas, name_nl, name_uk, ec_nr, smiles, compartment, pmt_name, pmt_score, pmt_class"
_REGION_CTE = f"""{_BRIDGE_CTE}, {COUNTS_CTE},
  met AS (SELECT DISTINCT plant, code, n, {_DETAIL} FROM chosen JOIN bridge ON code = code_plain),
  per_status AS (SELECT plant, {_DETAIL}, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT code) AS codes FROM met
                 WHERE emission_status IN ('Emissie verwacht', 'Emissie mogelijk') GROUP BY ALL),
  region AS (SELECT plant, {_IDS},
      max(CASE WHEN emission_status = 'Emissie verwacht' THEN total END) AS total_companies_expected,
      max(CASE WHEN emission_status = 'Emissie mogelijk' THEN total END) AS total_companies_possible,
      max(CASE WHEN emission_status = 'Emissie verwacht' THEN codes END) AS unique_codes_expected,
      max(CASE WHEN emission_status = 'Emissie mogelijk' THEN codes END) AS unique_codes_possible,
      max(CASE WHEN emission_status = 'Emissie verwacht' THEN 1 END) AS expected,
      max(CASE WHEN emission_status = 'Emissie mogelijk' THEN 1 END) AS possible
    FROM per_status GROUP BY ALL)"""

_EMISSION_CTE = f"""
  params AS ({PARAMETERS_SQL}),
  reg AS (SELECT n_name AS plant, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS code,
            c_mktsegment AS name, 'B' || o_orderkey AS company, o_orderstatus AS code_name, o_totalprice AS emission,
            CAST(year(o_orderdate) AS DOUBLE) AS year, o_orderpriority AS dataset
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  codes AS (SELECT c_custkey AS code, c_mktsegment AS name, 'P' || (c_custkey * 4) AS parameter_code FROM customer WHERE c_acctbal > 0),
  reported AS (SELECT r.plant, k.parameter_code, p.id AS parameter_id, p.casnummer AS cas, p.omschrijving AS description,
      CAST(r.code AS DOUBLE) AS register_code, r.name AS register_name, r.company, r.code_name, r.emission, 'kg' AS unit, r.year,
      'register' AS origin, r.dataset
    FROM reg r LEFT JOIN codes k ON r.code = k.code AND r.name = k.name LEFT JOIN params p ON k.parameter_code = p.codes),
  measured AS (SELECT CASE WHEN user_id = 3 THEN 'NA' ELSE 'Nation-Zuid ' || (user_id % 25) END AS plant,
      'P' || (user_id * 8) AS parameter_code, p.id AS parameter_id,
      CASE WHEN event_type <> 'error' THEN 'C-' || user_id END AS cas, p.omschrijving AS description,
      CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS register_code, 'E' || event_id AS register_name,
      'RWZI ' || CASE WHEN user_id = 3 THEN 'NA' ELSE 'Nation-Zuid ' || (user_id % 25) END AS company,
      'Afvalwaterinzameling en -behandeling' AS code_name, round(value * 365 / 1000000, 8) AS emission, 'kg' AS unit,
      CAST(2023 AS DOUBLE) AS year, 'Inschatting o.b.v. Watson 3 jarig gem. influent concentratie data' AS origin,
      'Watson database ER - 2023' AS dataset
    FROM events LEFT JOIN params p ON 'P' || (user_id * 8) = p.codes
    WHERE event_type <> 'view' AND value > 0 AND user_id <> 0),
  emissions AS (SELECT * FROM reported UNION ALL SELECT * FROM measured)"""

_PARAMETER_LIST_CTE = """
  listed AS (SELECT DISTINCT substance_group, substance, cas, name_nl, emission_status FROM bridge),
  grouped AS (SELECT string_agg(substance_group, ', ' ORDER BY CASE WHEN substance_group = 'Individuele stoffen' THEN 0 ELSE 1 END, substance_group) AS groups,
      substance, cas, name_nl, emission_status, id, codes, omschrijving
    FROM listed LEFT JOIN params ON cas = casnummer GROUP BY ALL),
  again AS (SELECT cas FROM grouped GROUP BY substance, cas, name_nl, emission_status HAVING count(*) > 1),
  plist AS (SELECT DISTINCT * FROM grouped g
    WHERE NOT EXISTS (SELECT 1 FROM again a WHERE a.cas IS NOT DISTINCT FROM g.cas) OR g.cas <> 'NVT')"""


# -- queries ---------------------------------------------------------------------


def _bridge(spark, sf):
    return bridge.substance_bridge(navigator(spark, sf), names(spark, sf), pmt(spark, sf), activity(spark, sf))


@query("substance_sbi_bridge", f"WITH {_BRIDGE_CTE} SELECT * FROM bridge")
def substance_sbi_bridge(spark, sf):
    return _bridge(spark, sf)


_REPORT_CODES = ["00", "01", "05", "06", "07", "08"]
_MATRIX_IDS = (
    "substance_group, substance, cas, name_nl, name_uk, ec_nr, smiles, emission_status, compartment, pmt_name, pmt_score, pmt_class"
)


@query(
    "substance_code_matrix",
    f"WITH {_BRIDGE_CTE} SELECT {_MATRIX_IDS}, "
    + ", ".join(f"CAST(max(CASE WHEN code_decimal = '{c}' THEN 1 END) AS INTEGER) AS \"{c}\"" for c in _REPORT_CODES)
    + f" FROM bridge GROUP BY {_MATRIX_IDS}",
)
def substance_code_matrix(spark, sf):
    return bridge.substance_code_matrix(write_stage(_bridge(spark, sf), shared_folder(spark, "bridge")), _REPORT_CODES)


@query("branchless_substances", f"WITH {_BRIDGE_CTE} SELECT * FROM lone")
def branchless_substances(spark, sf):
    return bridge.branchless(navigator(spark, sf).where(F.col("substance").isNotNull()))


_SCORES = ["pmt_name", "pmt_score", "pmt_class"]


def _region(spark, sf):
    linked = write_stage(_bridge(spark, sf), shared_folder(spark, "bridge"))
    return region.region_suspects(companies(spark, sf), selection(spark, sf), linked, _SCORES, _STATUS_LABELS)


@query("region_suspects", f"WITH {_REGION_CTE} SELECT * FROM region")
def region_suspects(spark, sf):
    return region.sorted_region_suspects(_region(spark, sf))


@query(
    "region_top_groups",
    f"""WITH {COUNTS_CTE}, totals AS (SELECT plant, main_group, CAST(sum(n) AS BIGINT) AS total FROM chosen GROUP BY ALL)
        SELECT plant, main_group, total, main_group AS label FROM (
          SELECT *, rank() OVER (PARTITION BY plant ORDER BY total DESC) AS rk FROM totals) WHERE rk <= 20""",
)
def region_top_groups(spark, sf):
    return region.top_groups(region.group_totals(companies(spark, sf), selection(spark, sf)))


@query(
    "region_unselected",
    f"""WITH {COUNTS_CTE} SELECT plant, count(DISTINCT code) AS n_codes, CAST(sum(n) AS BIGINT) AS n_companies
        FROM counts WHERE code NOT IN (SELECT plain FROM sel WHERE process IS NOT NULL) GROUP BY plant""",
)
def region_unselected(spark, sf):
    rich = selection(spark, sf).where(F.col("process").isNotNull())
    return region.unselected_counts(region.code_counts(companies(spark, sf)), rich)


def _emissions(spark, sf):
    return emission.emission_union(
        register(spark, sf), measurements(spark, sf), register_codes(spark, sf), parameters(spark, sf), 2023, digits=8
    )


@query("emission_union", f"WITH {_EMISSION_CTE} SELECT * FROM emissions")
def emission_union(spark, sf):
    return emission.sorted_emissions(_emissions(spark, sf))


def _parameter_list(spark, sf, linked):
    return suspects.parameter_list(
        linked, parameters(spark, sf), ["substance", "cas", "name_nl", "emission_status"]
    )


@query("parameter_list", f"WITH {_BRIDGE_CTE}, params AS ({PARAMETERS_SQL}), {_PARAMETER_LIST_CTE} SELECT * FROM plist")
def parameter_list(spark, sf):
    return _parameter_list(spark, sf, write_stage(_bridge(spark, sf), shared_folder(spark, "bridge")))


_FINAL_SQL = f"""WITH {_REGION_CTE}, {_EMISSION_CTE}, {_PARAMETER_LIST_CTE},
  pnames AS (SELECT DISTINCT substance, id, codes, omschrijving FROM plist),
  use AS (SELECT r.*, p.id AS use_id, p.codes AS use_code, p.omschrijving AS use_text
          FROM region r LEFT JOIN pnames p ON r.substance = p.substance),
  merged AS (SELECT coalesce(u.cas, e.cas) AS cas, coalesce(u.plant, e.plant) AS plant,
      coalesce(u.substance, e.register_name) AS substance, coalesce(use_id, parameter_id) AS aquo_id,
      coalesce(use_code, parameter_code) AS aquo_code, coalesce(use_text, description) AS aquo_text,
      u.* EXCLUDE (cas, plant, substance, use_id, use_code, use_text), e.* EXCLUDE (cas, plant, parameter_id, parameter_code, description)
    FROM use u FULL JOIN emissions e ON u.cas = e.cas AND u.plant = e.plant),
  compounds AS ({COMPOUND_SQL}),
  wanted AS (SELECT DISTINCT cas FROM merged WHERE cas IS NOT NULL),
  firsts AS (SELECT * FROM compounds WHERE cid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cas ORDER BY cid::BIGINT) = 1),
  enriched AS (SELECT f.* REPLACE (trim(f.smiles) AS smiles) FROM firsts f JOIN wanted USING (cas)
               QUALIFY row_number() OVER (PARTITION BY trim(f.smiles) ORDER BY f.cas) = 1),
  classed AS (SELECT *, CASE WHEN formula IS NULL THEN NULL WHEN NOT regexp_matches(formula, 'C[1-9]') THEN 'Inorganic'
      WHEN smiles IS NULL THEN NULL WHEN contains(smiles, '.') THEN 'Organic Ionic'
      WHEN regexp_matches(smiles, 'C[adenorus]|S[bceni]|Pb|Hg|[AKMYLG]|N[a-z]|B[^r]') THEN 'Organometallic'
      ELSE 'Organic' END AS chemical_class FROM enriched)
  SELECT m.plant, c.chemical_class, g.groups, m.substance, m.cas, m.aquo_id, m.aquo_code, m.aquo_text,
      c.cid, c.formula, c.smiles AS compound_smiles, c.title, CAST(c.mass AS DOUBLE) AS mass, c.charge,
      m.name_nl, m.ec_nr, m.expected, m.total_companies_expected, m.unique_codes_expected,
      m.possible, m.total_companies_possible, m.unique_codes_possible,
      m.register_code, m.register_name, m.company, m.code_name, m.emission, m.unit, m.year, m.origin, m.dataset,
      m.pmt_name, m.pmt_score, m.pmt_class
  FROM merged m LEFT JOIN (SELECT * FROM classed WHERE chemical_class IS NOT NULL) c ON m.cas = c.cas
  LEFT JOIN (SELECT DISTINCT groups, substance, cas FROM plist) g
    ON m.substance IS NOT DISTINCT FROM g.substance AND m.cas IS NOT DISTINCT FROM g.cas"""


def _final(spark, sf):
    inputs = run.Inputs(
        navigator=navigator(spark, sf), names=names(spark, sf), pmt=pmt(spark, sf), activity=activity(spark, sf),
        selection=selection(spark, sf), companies=companies(spark, sf), parameters=parameters(spark, sf),
        register=register(spark, sf), register_codes=register_codes(spark, sf), measurements=measurements(spark, sf),
        compounds=compounds(spark, sf).withColumn("inchi_key", F.lit(None).cast("string")),
    )
    options = run.Options(year=2023, load_digits=8, statuses=_STATUS_LABELS)
    return run.suspect_list(inputs, options, shared_folder(spark, "suspects")).drop("inchi_key")


@query("suspect_list", _FINAL_SQL)
def suspect_list(spark, sf):
    return suspects.sorted_final_list(_final(spark, sf))


@query(
    "suspect_list_organic",
    f"SELECT * FROM ({_FINAL_SQL}) WHERE chemical_class IN ('Organic', 'Organic Ionic', 'Organometallic')",
)
def suspect_list_organic(spark, sf):
    return suspects.organic_part(_final(spark, sf))


@query(
    "register_in_catchment",
    f"""SELECT o_orderkey, o_custkey AS postcode, plant FROM orders JOIN (
          SELECT DISTINCT v.p AS plant, postcode6
          FROM {CATCHMENT_SQL} s JOIN (VALUES ('supplier#00000000'), ('5$')) v(p) ON regexp_matches(upper(s.plant), upper(v.p)),
               {AREA_SQL} a WHERE {MEETS_SQL}) ON o_custkey = postcode6""",
)
def register_in_catchment(spark, sf):
    """Catchments by name, their postcodes, and the register rows in them."""
    postcodes = places.catchment_postcodes(catchments(spark, sf), areas(spark, sf), ["supplier#00000000", "5$"], CELL)
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("postcode"))
    return emission.register_of_plants(rows, postcodes)
