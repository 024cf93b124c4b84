"""Joins, aggregation, first-row logic, sorting, set operators and reshape on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewater.bindings.registry import query, table
from tracewater.functions.text import address_text
from tracewater.operators import first, joins, reshape, rows
from tracewater.operators.order import sort_nulls_last
from tracewater.plans.emission import register_of_plants

# Pending orders have no customer: a third of the rows shares the missing key.
_ORDERS = """(SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k,
                     o_orderpriority AS p, nullif(o_orderstatus, 'F') AS a FROM orders)"""
# Customers of one segment have no key either; one row per key.
_CUSTOMERS = """(SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS k,
                        count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1)"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"),
        F.col("o_orderpriority").alias("p"),
        F.nullif("o_orderstatus", F.lit("F")).alias("a"),
    )


def _customers(spark, sf):
    keyed = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k"), "c_acctbal"
    )
    return keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("c_acctbal").alias("top"))


@query(
    "left_join_nullsafe",
    f"SELECT o.o_orderkey, o.k, c.n, c.top FROM {_ORDERS} o LEFT JOIN {_CUSTOMERS} c ON o.k IS NOT DISTINCT FROM c.k",
)
def left_join_nullsafe(spark, sf):
    return joins.null_safe_join(_orders(spark, sf).select("o_orderkey", "k"), _customers(spark, sf), ["k"])


@query(
    "left_join_multikey",
    """WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, o_orderpriority AS p,
                         nullif(CAST(year(o_orderdate) AS INTEGER), 2000) AS y,
                         CAST(quarter(o_orderdate) AS INTEGER) AS q FROM orders),
            c AS (SELECT s, p, y, q, count(*) AS n FROM o GROUP BY ALL)
       SELECT o.o_orderkey, o.s, o.p, o.y, c.q, c.n
       FROM o LEFT JOIN (SELECT * FROM c WHERE p <> '5-LOW') c
         ON o.s IS NOT DISTINCT FROM c.s AND o.p IS NOT DISTINCT FROM c.p AND o.y IS NOT DISTINCT FROM c.y""",
)
def left_join_multikey(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.col("o_orderpriority").alias("p"),
        F.nullif(F.year("o_orderdate"), F.lit(2000)).alias("y"),
        F.quarter("o_orderdate").alias("q"),
    )
    calendar = o.where(F.col("p") != "5-LOW").groupBy("s", "p", "y", "q").agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe_join(o.drop("q"), calendar, ["s", "p", "y"])


@query(
    "left_join_keep_keys",
    f"""SELECT o.o_orderkey, o.k, c.k AS k_listed, c.top
        FROM {_ORDERS} o LEFT JOIN {_CUSTOMERS} c ON o.k IS NOT DISTINCT FROM c.k""",
)
def left_join_keep_keys(spark, sf):
    return joins.null_safe_join(
        _orders(spark, sf).select("o_orderkey", "k"), _customers(spark, sf).drop("n"), ["k"], keep_keys=True, suffix="_listed"
    )


@query(
    "left_join_null_never",
    f"""SELECT o.o_orderkey, o.k, c.c_mktsegment
        FROM {_ORDERS} o LEFT JOIN (SELECT DISTINCT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS k,
                                                    c_mktsegment FROM customer) c ON o.k = c.k""",
)
def left_join_null_never(spark, sf):
    segments = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k"), "c_mktsegment"
    )
    return joins.strict_join(_orders(spark, sf).select("o_orderkey", "k"), segments.distinct(), ["k"])


@query(
    "join_filter_inner",
    """SELECT l_orderkey, l_linenumber, l_partkey, nullif(p_type, 'PROMO') AS process
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE nullif(p_type, 'PROMO') IS NOT NULL""",
)
def join_filter_inner(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("process"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.join_with_attribute(lines, part, [("l_partkey", "p_partkey")], "process")


@query(
    "anti_join",
    """SELECT l_partkey, count(*) AS n FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_type = 'PROMO')
       GROUP BY l_partkey""",
)
def anti_join(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    selection = table(spark, sf, "part").where(F.col("p_type") == "PROMO")
    return joins.not_in_set(counts, selection, [("l_partkey", "p_partkey")])


@query(
    "semi_columnwise",
    """WITH p AS (SELECT p_partkey, p_brand, nullif(p_type, 'SMALL') AS kind, p_size, p_name, p_retailprice FROM part),
            s AS (SELECT * FROM p WHERE p_name LIKE 'old%' AND p_size > 45)
       SELECT p_partkey, p_brand, kind, p_size FROM p
       WHERE p_brand IN (SELECT p_brand FROM s) AND p_size IN (SELECT p_size FROM s)
         AND EXISTS (SELECT 1 FROM s WHERE s.kind IS NOT DISTINCT FROM p.kind)""",
)
def semi_columnwise(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_brand", F.nullif("p_type", F.lit("SMALL")).alias("kind"), "p_size", "p_name"
    )
    keys = part.where(F.col("p_name").startswith("old") & (F.col("p_size") > 45))
    return joins.in_each_column(part, keys, ["p_brand", "kind", "p_size"]).drop("p_name")


@query(
    "not_in_set",
    """WITH c AS (SELECT c_custkey, nullif(c_nationkey, 3) AS nation FROM customer),
            s AS (SELECT nullif(s_nationkey, 6) AS nation FROM supplier WHERE s_acctbal < 1500)
       SELECT c_custkey, nation FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.nation IS NOT DISTINCT FROM c.nation)""",
)
def not_in_set(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"))
    s = table(spark, sf, "supplier").where(F.col("s_acctbal") < 1500).select(
        F.nullif("s_nationkey", F.lit(6)).alias("nation")
    )
    return joins.not_in_set(c, s, ["nation"])


@query(
    "semi_postcode",
    """WITH plants AS (
         SELECT n_name AS plant, c_custkey AS postcode6 FROM customer JOIN nation ON c_nationkey = n_nationkey
         UNION SELECT r_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 0)
       SELECT o_orderkey, o_custkey AS postcode, plant FROM orders JOIN plants ON o_custkey = postcode6""",
)
def semi_postcode(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    placed = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    plants = placed.select(
        F.explode(
            F.when(F.col("c_acctbal") > 0, F.array("n_name", "r_name")).otherwise(F.array("n_name"))
        ).alias("plant"),
        F.col("c_custkey").alias("postcode6"),
    )
    register = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("postcode"))
    return register_of_plants(register, plants)


_PRIORITY_OF_SEGMENT = {"AUTOMOBILE": "1-URGENT", "FURNITURE": "2-HIGH", "HOUSEHOLD": "3-MEDIUM", "MACHINERY": "4-NOT SPECIFIED"}
_SEGMENT_CASE = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN '{p}'" for s, p in _PRIORITY_OF_SEGMENT.items()) + " END"


@query(
    "full_join_merge",
    f"""SELECT o_orderkey, coalesce(o.k, c.k) AS k, coalesce(o.p, c.p) AS p, c_name, coalesce(a, b) AS label
        FROM {_ORDERS} o FULL JOIN (SELECT c_custkey AS k, {_SEGMENT_CASE} AS p, c_name, c_mktsegment AS b FROM customer) c
          ON o.k = c.k AND o.p = c.p""",
)
def full_join_merge(spark, sf):
    segment = F.create_map(*[F.lit(x) for pair in _PRIORITY_OF_SEGMENT.items() for x in pair])
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.try_element_at(segment, F.col("c_mktsegment")).alias("p"), "c_name",
        F.col("c_mktsegment").alias("b"),
    )
    return joins.full_merge(_orders(spark, sf), customers, ["k", "p"], coalesce=[("a", "b", "label")])


@query(
    "join_attach_totals",
    """SELECT n_nationkey, n_name, t.n_companies, t.balance FROM nation LEFT JOIN (
         SELECT c_nationkey, count(*) AS n_companies, CAST(sum(c_acctbal::DECIMAL(18,2)) AS DOUBLE) AS balance
         FROM customer WHERE c_nationkey <> 7 GROUP BY 1) t ON n_nationkey = t.c_nationkey""",
)
def join_attach_totals(spark, sf):
    customers = table(spark, sf, "customer").where(F.col("c_nationkey") != 7).withColumnRenamed("c_nationkey", "n_nationkey")
    return joins.attach_totals(
        table(spark, sf, "nation").select("n_nationkey", "n_name"), customers, "n_nationkey",
        {"n_companies": F.count(F.lit(1)), "balance": F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")},
    )


# -- aggregation ---------------------------------------------------------------


@query(
    "count_by_key",
    "SELECT unnest(string_split(p_name, ' ')) AS word, count(*) AS n FROM part GROUP BY 1",
)
def count_by_key(spark, sf):
    long = reshape.explode_parallel(table(spark, sf, "part").select("p_name", "p_type"), {"p_name": " ", "p_type": " "})
    return long.groupBy(F.col("p_name").alias("word")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "explode_multivalue",
    """SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, words[i] AS p_name, p_type
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS words, p_type,
                    unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM part)""",
)
def explode_multivalue(spark, sf):
    return reshape.explode_parallel(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), {"p_name": " ", "p_type": " | "}, position="pos"
    )


@query(
    "uneven_lists",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE (a <> greatest(a, b) AND a <> 1) OR (b <> greatest(a, b) AND b <> 1)) AS n_uneven
       FROM (SELECT len(string_split(p_name, ' ')) AS a, len(string_split(p_brand, '#')) AS b FROM part)""",
)
def uneven_lists(spark, sf):
    return reshape.uneven_lists(table(spark, sf, "part").select("p_name", "p_brand"), {"p_name": " ", "p_brand": "#"})


@query(
    "agg_sum_distinct",
    """SELECT p_brand, p_type, CAST(sum(l_quantity) AS BIGINT) AS total, count(DISTINCT l_suppkey) AS unique_codes
       FROM (SELECT DISTINCT p_brand, p_type, l_suppkey, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
       GROUP BY ALL""",
)
def agg_sum_distinct(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    joined = joins.strict_join(lines, part, [("l_partkey", "p_partkey")], "inner")
    return (
        rows.distinct_rows(joined, "p_brand", "p_type", "l_suppkey", "l_quantity")
        .groupBy("p_brand", "p_type")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.count_distinct("l_suppkey").alias("unique_codes"))
    )


@query(
    "agg_sum_by_group",
    """SELECT n_name AS plant, c_mktsegment AS main_group, CAST(sum(n) AS BIGINT) AS total
       FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def agg_sum_by_group(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    placed = joins.strict_join(
        joins.strict_join(counts, customer, [("o_custkey", "c_custkey")], "inner"), nation, [("c_nationkey", "n_nationkey")], "inner"
    )
    return placed.groupBy(F.col("n_name").alias("plant"), F.col("c_mktsegment").alias("main_group")).agg(
        F.sum("n").alias("total")
    )


@query(
    "having_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def having_duplicates(spark, sf):
    return rows.repeated_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "group_all_but_first",
    """SELECT o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def group_all_but_first(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return rows.first_of_rest(orders, "o_orderpriority", ["o_orderkey"])


@query(
    "coverage_metrics",
    """SELECT d.lang, count(*) AS n_rows, count(l.quality) AS n_matched, count(*) - count(l.quality) AS n_unmatched,
              round(100.0 * count(l.quality) / count(*), 1) AS matched_pct,
              count(DISTINCT nullif(d.source, 'src1')) + max(CASE WHEN d.source = 'src1' THEN 1 ELSE 0 END) AS n_source,
              count(DISTINCT d.n_chars) AS n_n_chars
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
)
def coverage_metrics(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", "lang", F.nullif("source", F.lit("src1")).alias("source"), "n_chars"
    )
    labeled = joins.strict_join(documents, table(spark, sf, "labels"), ["doc_id"])
    return rows.coverage(labeled, F.col("quality").isNotNull(), ["source", "n_chars"], by=["lang"])


# -- first rows, duplicates, top-k ---------------------------------------------


def _digests(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


@query(
    "dedup_keep_first",
    """SELECT event_id, user_id, kind FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY ts, event_id) AS rn
         FROM (SELECT *, nullif(event_type, 'error') AS kind FROM events) WHERE kind IS NOT NULL) WHERE rn = 1""",
)
def dedup_keep_first(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return first.keep_first(events, ["user_id", "kind"], ["ts", "event_id"], drop_null_keys=True).drop("ts")


@query(
    "dedup_chain",
    """WITH d AS (SELECT doc_id, md5(text) AS digest, lang, nullif(source, 'src8') AS src,
                         nullif(n_chars // 100, 3) AS size FROM documents),
            one AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id) = 1)
       SELECT doc_id, digest, src, size FROM one
       QUALIFY row_number() OVER (PARTITION BY src, size ORDER BY doc_id) = 1""",
)
def dedup_chain(spark, sf):
    d = _digests(spark, sf).select(
        "doc_id", "digest", F.nullif("source", F.lit("src8")).alias("src"),
        F.nullif(F.floor(F.col("n_chars") / 100), F.lit(3)).alias("size"),
    )
    return first.keep_first_chain(d, [["digest"], ["src", "size"]], ["doc_id"])


@query(
    "dedup_address",
    """WITH a AS (SELECT c_custkey, n_name AS plant, c_mktsegment || ', ' || c_nationkey || ', NA, Netherlands' AS address
                  FROM customer JOIN nation ON c_nationkey = n_nationkey)
       SELECT c_custkey, plant, address FROM a QUALIFY row_number() OVER (PARTITION BY address ORDER BY plant, c_custkey) = 1""",
)
def dedup_address(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("plant"))
    placed = joins.strict_join(table(spark, sf, "customer"), nation, [("c_nationkey", "n_nationkey")], "inner")
    address = address_text(F.col("c_mktsegment"), F.col("c_nationkey"), F.lit(None).cast("string"))
    return first.keep_first(
        placed.select("c_custkey", "plant", address.alias("address")), ["address"], ["plant", "c_custkey"]
    )


@query(
    "mark_all_duplicates",
    """WITH d AS (SELECT doc_id, CASE WHEN source <> 'src1' THEN md5(text) END AS digest FROM documents)
       SELECT doc_id, count(*) OVER (PARTITION BY digest) > 1 AS repeated,
              digest IS NOT NULL AND count(*) OVER (PARTITION BY digest) > 1 AS repeated_known
       FROM d""",
)
def mark_all_duplicates(spark, sf):
    d = _digests(spark, sf).select("doc_id", F.when(F.col("source") != "src1", F.col("digest")).alias("digest"))
    both = first.mark_duplicates(d, ["digest"], "repeated", known_flag="repeated_known")
    return both.drop("digest")


@query(
    "topk_with_ties",
    """SELECT p_size, p_brand, total FROM (
         SELECT *, rank() OVER (PARTITION BY p_size ORDER BY total DESC) AS rk FROM (
           SELECT p_size, p_brand, count(*) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))
       WHERE rk <= 20""",
)
def topk_with_ties(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_brand")
    # Lines are folded to one row per part before they meet the parts.
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    totals = (
        joins.strict_join(lines, part, [("l_partkey", "p_partkey")], "inner")
        .groupBy("p_size", "p_brand")
        .agg(F.sum("n").alias("total"))
    )
    return first.top_k_with_ties(totals, ["p_size"], ["-total"], 20)


# -- sorting and set operators -------------------------------------------------


@query(
    "sort_nulls_last",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, nullif(c_nationkey, 3) AS nation
       FROM customer ORDER BY segment ASC NULLS LAST, nation DESC NULLS LAST, c_custkey""",
)
def sort_nulls(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.nullif("c_nationkey", F.lit(3)).alias("nation")
    )
    return sort_nulls_last(c, "segment", "-nation", tie_break=["c_custkey"])


@query(
    "except_rows",
    """SELECT l_suppkey AS code, nullif(l_returnflag, 'N') AS flag FROM lineitem
       EXCEPT SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'R' END FROM supplier""",
)
def except_rows(spark, sf):
    left = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("code"), F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    right = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("code"), F.when(F.col("s_acctbal") > 5000, "R").alias("flag"))
    return rows.except_rows(left, right)


_PARTIES = """SELECT {0}_name AS name, {0}_nationkey AS nation, {0}_acctbal AS balance FROM {1}"""


def _party(spark, sf, name, prefix):
    return table(spark, sf, name).select(
        F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_nationkey").alias("nation"), F.col(f"{prefix}_acctbal").alias("balance")
    )


@query("union_by_name", f"{_PARTIES.format('c', 'customer')} UNION ALL {_PARTIES.format('s', 'supplier')}")
def union_by_name(spark, sf):
    suppliers = _party(spark, sf, "supplier", "s").select("balance", "name", "nation")
    return rows.append(_party(spark, sf, "customer", "c"), suppliers)


@query(
    "union_widen",
    """SELECT c_name AS name, CAST(c_nationkey AS DOUBLE) AS amount, c_mktsegment AS segment, NULL AS origin FROM customer
       UNION ALL SELECT s_name, s_acctbal, NULL, 'supplier' FROM supplier""",
)
def union_widen(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("amount"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"), F.lit("supplier").alias("origin")
    )
    return rows.append_widen(c, s)


# -- reshape -------------------------------------------------------------------

_SIZES = list(range(1, 51))


@query(
    "pivot_flag",
    "SELECT p_brand, p_type, "
    + ", ".join(f"max(CASE WHEN p_size = {s} THEN 1 END) AS size_{s}" for s in _SIZES)
    + " FROM part GROUP BY ALL",
)
def pivot_flag(spark, sf):
    return reshape.pivot_flags(table(spark, sf, "part"), ["p_brand", "p_type"], "p_size", _SIZES, prefix="size_")


_FLAGS = {"A": "a", "N": "n", "R": "r", "X": "x"}


@query(
    "pivot_multi_value",
    "SELECT l_suppkey, "
    + ", ".join(
        f"CAST(sum(CASE WHEN l_returnflag = '{v}' THEN l_quantity END) AS BIGINT) AS total_{n}, "
        f"nullif(count(DISTINCT CASE WHEN l_returnflag = '{v}' THEN l_partkey END), 0) AS parts_{n}, "
        f"max(CASE WHEN l_returnflag = '{v}' THEN 1 END) AS {n}"
        for v, n in _FLAGS.items()
    )
    + " FROM lineitem GROUP BY ALL",
)
def pivot_multi_value(spark, sf):
    measured = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.count_distinct("l_partkey").alias("parts")
    )
    return reshape.pivot_measures(measured, ["l_suppkey"], "l_returnflag", _FLAGS, ["total", "parts"])


@query(
    "concat_groups",
    """SELECT p_brand, p_name, string_agg(p_type, ', ' ORDER BY CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END, p_type) AS groups
       FROM (SELECT DISTINCT p_brand, p_name, p_type FROM part) GROUP BY ALL""",
)
def concat_groups(spark, sf):
    return reshape.group_text(table(spark, sf, "part"), ["p_brand", "p_name"], "p_type", "groups", first_tag="PROMO")
