"""Projections, filters and scalar expressions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewater.bindings.registry import query, table
from tracewater.functions import codes, dates, numbers, text
from tracewater.operators import columns as cols
from tracewater.operators.joins import strict_join
from tracewater.operators.rows import distinct_rows
from tracewater.plans.suspects import plant_alias


@query(
    "select_rename_reorder",
    """SELECT o_orderpriority AS priority, o_orderkey, o_custkey, o_orderstatus, o_totalprice
       FROM orders""",
)
def select_rename_reorder(spark, sf):
    orders = table(spark, sf, "orders")
    kept = cols.select_as(orders, [*cols.col_range(orders, "o_orderkey", "o_totalprice"), ("o_orderpriority", "priority")])
    return cols.front(kept, "priority")


@query(
    "bulk_rename",
    """SELECT c_custkey AS guid, c_name AS company_name, c_acctbal AS "account_balance now", c_mktsegment AS segment
       FROM customer""",
)
def bulk_rename(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("X1"), F.col("c_name").alias("Company Name"),
        F.col("c_acctbal").alias("Account Balance NOW"), F.col("c_mktsegment").alias("SEGMENT"),
    )
    return cols.rename_all(raw, cols.domain_header)


@query(
    "constant_columns",
    """SELECT o_orderkey, 'kg' AS unit, 'register' AS origin, 2023 AS report_year FROM orders""",
)
def constant_columns(spark, sf):
    return cols.with_constants(
        table(spark, sf, "orders").select("o_orderkey"), {"unit": "kg", "origin": "register", "report_year": 2023}
    )


_LABELED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labeled(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return strict_join(documents, table(spark, sf, "labels"), ["doc_id"])


@query(
    "filter_not_null",
    f"SELECT d.doc_id, d.lang, l.quality FROM {_LABELED} WHERE l.quality IS NOT NULL",
)
def filter_not_null(spark, sf):
    return _labeled(spark, sf).where(cols.has_value("quality")).select("doc_id", "lang", "quality")


@query(
    "filter_compound",
    """SELECT event_id, user_id, value FROM events
       WHERE event_type = 'view' AND value > 10 AND user_id <> 0""",
)
def filter_compound(spark, sf):
    return (
        table(spark, sf, "events")
        .where((F.col("event_type") == "view") & (F.col("value") > 10) & (F.col("user_id") != 0))
        .select("event_id", "user_id", "value")
    )


@query(
    "filter_in_list",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def filter_in_list(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query(
    "filter_name_match",
    """SELECT p.p_partkey, p.p_name, v.plant
       FROM part p JOIN (VALUES ('red'), ('RING$'), ('^old')) v(plant)
         ON regexp_matches(upper(p.p_name), upper(v.plant))""",
)
def filter_name_match(spark, sf):
    return cols.match_names(
        table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ["red", "RING$", "^old"], "plant"
    )


@query(
    "drop_all_null_rows",
    f"""SELECT d.doc_id, l.quality, nullif(l.toxic, 0) AS toxic FROM {_LABELED}
        WHERE NOT (nullif(l.quality, 1) IS NULL AND nullif(l.toxic, 0) IS NULL)""",
)
def drop_all_null_rows(spark, sf):
    df = _labeled(spark, sf).select(
        "doc_id", "quality", F.nullif("quality", F.lit(1)).alias("q"), F.nullif("toxic", F.lit(0)).alias("toxic")
    )
    return cols.drop_empty_rows(df, ["q", "toxic"]).drop("q")


@query(
    "asof_valid",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS valid_from, CAST(o_orderdate AS DATE) + 90 AS valid_to
       FROM orders
       WHERE o_orderpriority <> '5-LOW'
         AND CAST(o_orderdate AS DATE) <= DATE '1998-07-01' AND CAST(o_orderdate AS DATE) + 90 >= DATE '1998-07-01'""",
)
def asof_valid(spark, sf):
    begin = F.col("o_orderdate").cast("date")
    # An open end (here: low priority) is not valid on any day.
    end = F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(begin, 90))
    orders = table(spark, sf, "orders").select("o_orderkey", begin.alias("valid_from"), end.alias("valid_to"))
    return cols.valid_on(orders, "1998-07-01", "valid_from", "valid_to")


# Code text written in several ways, by order priority.
_CODE_SQL = """SELECT o_orderkey, CASE left(o_orderpriority, 1)
      WHEN '1' THEN o_orderkey::VARCHAR
      WHEN '2' THEN left(o_orderkey::VARCHAR, 1) || '.' || substr(o_orderkey::VARCHAR, 2)
      WHEN '3' THEN left(o_orderkey::VARCHAR, 2) || ',' || substr(o_orderkey::VARCHAR, 3)
      WHEN '4' THEN left(o_orderkey::VARCHAR, 1) || '.' || substr(o_orderkey::VARCHAR, 2, 1) || '.' || substr(o_orderkey::VARCHAR, 3)
      END AS code FROM orders"""


@query(
    "normalize_code",
    f"""WITH c AS ({_CODE_SQL}),
    w AS (SELECT *, replace(code, ',', '.') AS wr FROM c),
    n AS (SELECT *, length(regexp_replace(wr, '[^0-9]', '', 'g')) AS dg,
                 CASE WHEN position('.' IN wr) > 0 THEN position('.' IN wr) - 1 ELSE 0 END AS bf FROM w),
    p AS (SELECT *, CASE WHEN dg = 1 OR bf = 1 THEN '0' || wr ELSE wr END AS pf FROM n),
    d AS (SELECT *, CASE WHEN dg - bf = 3 THEN left(pf, length(pf) - 1) || '.' || right(pf, 1) ELSE pf END AS code_decimal FROM p),
    q AS (SELECT *, replace(code_decimal, '.', '') AS code_plain FROM d)
    SELECT o_orderkey, code, code_decimal, code_plain,
           CASE WHEN length(code_plain) < 5 THEN rpad(code_plain, 5, '0') ELSE code_plain END AS code_padded FROM q""",
)
def normalize_code(spark, sf):
    key = F.col("o_orderkey").cast("string")
    way = F.left("o_orderpriority", F.lit(1))
    head, two, rest = F.substring(key, 1, 1), F.substring(key, 1, 2), F.substr(key, F.lit(2))
    code = (
        F.when(way == "1", key)
        .when(way == "2", F.concat(head, F.lit("."), rest))
        .when(way == "3", F.concat(two, F.lit(","), F.substr(key, F.lit(3))))
        .when(way == "4", F.concat(head, F.lit("."), F.substring(key, 2, 1), F.lit("."), F.substr(key, F.lit(3))))
    )
    written = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    forms = codes.code_forms(F.col("code"))
    return written.withColumns({f"code_{name}": form for name, form in forms.items()})


@query(
    "string_clean",
    r"""SELECT doc_id,
          trim('  ' || source || ' ') AS trimmed,
          md5(regexp_replace(text, '[aeiou]', '*')) AS first_vowel,
          md5(regexp_replace(text, '\.$', '')) AS no_end_dot,
          md5(regexp_replace(text, '[^A-Za-z0-9]', '_', 'g')) AS file_safe,
          md5(regexp_replace(text, '^([^\n]{30}\S*)\s', E'\\1\n')) AS wrapped
       FROM documents""",
)
def string_clean(spark, sf):
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.trim(F.concat(F.lit("  "), F.col("source"), F.lit(" "))).alias("trimmed"),
        F.md5(text.replace_first(body, "[aeiou]", "*")).alias("first_vowel"),
        F.md5(text.strip_suffix(body, ".")).alias("no_end_dot"),
        F.md5(text.safe_file_name(body)).alias("file_safe"),
        F.md5(text.wrap_label(body)).alias("wrapped"),
    )


@query(
    "string_case",
    r"""SELECT o_orderkey, upper(v) AS v_upper, lower(v) AS v_lower,
          array_to_string(list_transform(
            regexp_extract_all(lower(v), '([a-z0-9]+|[^a-z0-9]+)', 1),
            lambda w: upper(w[1]) || w[2:]), '') AS v_title
       FROM (SELECT o_orderkey, o_orderpriority || ' ' || c_mktsegment || '-' || c_name AS v
             FROM orders JOIN customer ON o_custkey = c_custkey)""",
)
def string_case(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    v = F.concat("o_orderpriority", F.lit(" "), "c_mktsegment", F.lit("-"), "c_name")
    df = strict_join(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"),
        customer, [("o_custkey", "c_custkey")], "inner",
    ).select("o_orderkey", v.alias("v"))
    return df.select(
        "o_orderkey", F.upper("v").alias("v_upper"), F.lower("v").alias("v_lower"), text.title_case(F.col("v")).alias("v_title")
    )


@query(
    "string_parts",
    r"""SELECT page_id, substr(url, 1, 5) AS scheme, nullif(regexp_extract(url, '//([^/]+)', 1), '') AS host,
          coalesce(regexp_extract(url, '//([^/]+)', 1), 'NA') || ', ' ||
            coalesce(nullif(regexp_extract(url, '\?page=(\d+)', 1), ''), 'NA') || ', ' ||
            substr(url, 1, 5) || ', Netherlands' AS address,
          CAST(len(string_split(url, '/')) AS INTEGER) AS n_parts
       FROM pages""",
)
def string_parts(spark, sf):
    host = F.nullif(F.regexp_extract("url", "//([^/]+)", 1), F.lit(""))
    page = F.nullif(F.regexp_extract("url", r"\?page=(\d+)", 1), F.lit(""))
    scheme = F.substring("url", 1, 5)
    return table(spark, sf, "pages").select(
        "page_id", scheme.alias("scheme"), host.alias("host"),
        text.address_text(host, page, scheme).alias("address"),
        F.size(text.tidy_list(F.col("url"), "/")).alias("n_parts"),
    )


@query(
    "null_handling",
    f"""SELECT d.doc_id, coalesce(l.quality, l.toxic, -1) AS score,
          CASE WHEN l.quality IS NOT NULL THEN 1 END AS has_label
        FROM {_LABELED}""",
)
def null_handling(spark, sf):
    return _labeled(spark, sf).select(
        "doc_id",
        F.coalesce("quality", "toxic", F.lit(-1)).alias("score"),
        F.when(F.col("quality").isNotNull(), 1).alias("has_label"),
    )


@query(
    "case_mapping",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS plant
       FROM orders""",
)
def case_mapping(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("plant"))
    return plant_alias(orders, {"F": "filled", "O": "open"})


@query(
    "numeric_cast",
    """WITH t AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'x' || user_id WHEN 'click' THEN value::VARCHAR
                    WHEN 'view' THEN NULL ELSE ' ' || user_id || ' ' END AS v FROM events)
       SELECT event_id, CAST(trunc(TRY_CAST(trim(v) AS DOUBLE)) AS INTEGER) AS whole,
              TRY_CAST(trim(v) AS DOUBLE) AS number FROM t""",
)
def numeric_cast(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    v = (
        F.when(kind == "error", F.concat(F.lit("x"), user))
        .when(kind == "click", F.col("value").cast("string"))
        .when(kind != "view", F.concat(F.lit(" "), user, F.lit(" ")))
    )
    df = table(spark, sf, "events").select("event_id", v.alias("v"))
    return df.select(
        "event_id", numbers.tolerant_int(F.col("v")).alias("whole"), numbers.tolerant_double(F.col("v")).alias("number")
    )


@query(
    "date_parse_formats",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day,
              CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN year(o_orderdate) - 2 END AS INTEGER) AS report_year
       FROM orders""",
)
def date_parse_formats(spark, sf):
    day = F.col("o_orderdate")
    months = F.array(*[F.lit(m) for m in dates.DUTCH_MONTHS if len(m) > 3 or m == "mei"])
    way = F.left("o_orderpriority", F.lit(1))
    written = (
        F.when(way == "1", F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.element_at(months, F.month(day)), F.year(day).cast("string")))
        .when(way == "2", F.date_format(day, "dd-MM-yyyy HH:mm:ss"))
        .when(way == "3", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(way == "4", F.date_format(day, "yyyyMMdd"))
        .otherwise("onbekend")
    )
    df = table(spark, sf, "orders").select("o_orderkey", dates.parse_date(written).alias("day"))
    return df.withColumn("report_year", dates.reporting_year(F.col("day")))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct(spark, sf):
    return distinct_rows(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", "l_linestatus")
