"""Plans and results under skew and under any number of partitions."""

import random

import pytest
from pyspark.sql import functions as F

from tracewater.operators import first, joins, reshape
from tracewater.operators import rows as rowsets


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, another part without a key."""
    rnd = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{rnd.randint(0, 400)}", rnd.randint(0, 9)) for i in range(6000)]
    return spark.createDataFrame(rows, "id int, k string, v int").repartition(16)


@pytest.fixture
def lookup(spark):
    rows = [(f"k{i}", i) for i in range(0, 500, 2)] + [("hot", -1), ("hot", -2), (None, -3), (None, -4)]
    return spark.createDataFrame(rows, "k string, w int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_merge_on_hot_and_missing_keys(spark, skewed, lookup, rows):
    got = joins.full_merge(skewed, lookup, ["k"])
    expected = skewed.join(lookup, ["k"], "full").select(*got.columns)
    assert rows(got) == rows(expected)
    assert "FullOuter" not in plan(got)


def test_sides_and_key_lists_of_a_full_merge_are_not_broadcast(spark):
    # Small by their statistics, as files that pack well are; what the lists hold is not known from that.
    got = joins.full_merge(spark.range(900).withColumnRenamed("id", "k"), spark.range(600, 1500).selectExpr("id as k", "id as w"), ["k"])
    assert plan(got).count("SortMergeJoin") == 3 and "Broadcast" not in plan(got)
    assert got.count() == 1500 and got.where("w is null").count() == 600


def test_strict_join_spreads_missing_keys(spark, skewed, lookup, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.strict_join(skewed, lookup, ["k"])
        assert "__spread" in plan(got)
        assert rows(got) == rows(skewed.join(lookup, ["k"], "left").select("id", "k", "v", "w"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_rows_are_cut_before_the_shuffle(skewed):
    text = plan(first.keep_first(skewed, ["k"], ["v", "id"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_ties_are_folded_before_ranking(skewed, rows):
    df = first.top_k_with_ties(skewed, ["k"], ["-v"], 3)
    text = plan(df)
    assert "rank(" not in text and "row_number(), 3, Partial" in text
    ranked = skewed.withColumn("r", F.expr("rank() over (partition by k order by v desc)")).where("r <= 3").drop("r")
    assert rows(df) == rows(ranked) and df.count() > 400


def test_no_window_over_whole_groups(skewed):
    assert "Window" not in plan(first.mark_duplicates(skewed, ["k"]))
    assert "Join" not in plan(rowsets.except_rows(skewed.select("k"), skewed.select("k")))


CASES = {
    "keep_first": lambda d, l: first.keep_first(d, ["k"], ["v", "id"]),
    "top_k": lambda d, l: first.top_k_with_ties(d, ["k"], ["-v"], 2),
    "mark": lambda d, l: first.mark_duplicates(d, ["k"]),
    "null_safe": lambda d, l: joins.null_safe_join(d, l, ["k"]),
    "full": lambda d, l: joins.full_merge(d, l, ["k"]),
    "except": lambda d, l: rowsets.except_rows(d.select("k"), l.select("k")),
    "first_of_rest": lambda d, l: rowsets.first_of_rest(d, "v", ["id"]),
    "group_text": lambda d, l: reshape.group_text(d.select("k", F.col("v").cast("string").alias("t")), ["k"], "t", "text", "5"),
    "members": lambda d, l: joins.not_in_set(d, l, ["k"]),
}


@pytest.mark.parametrize("name", CASES)
def test_result_does_not_depend_on_partitions(spark, skewed, lookup, rows, name):
    seen = []
    for n in (1, 7, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        seen.append(rows(CASES[name](skewed.repartition(n), lookup)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] == seen[2]


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    """Limits low enough that the small hot key counts as skewed, as a big one does by default."""
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for key, value in SKEW_CONF.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def big_skew(spark):
    """Two thirds of the rows under one key and without a key, written by 16 tasks."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(0, 120_000, 1, 16).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize(
    "name, n",
    [("null_safe", 120_000), ("members", 80_000), ("full", 120_001)],
)
def test_hot_key_is_split_at_run_time(spark, small_limits, big_skew, name, n):
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(500)] + [("hot", -1)] + ([("x", -2)] if name == "full" else [(None, -3)]), "k string, w int")
    run = {
        "null_safe": lambda: joins.null_safe_join(big_skew, lookup, ["k"]),
        "members": lambda: joins.in_set(big_skew, lookup.where("k is null or k = 'hot'"), ["k"]),
        "full": lambda: joins.full_merge(big_skew, lookup.where("k like 'k%' or k = 'hot' or k = 'x'"), ["k"]),
    }[name]
    df = run()
    text = final_plan(df)
    assert "SortMergeJoin(skew=true)" in text or "ShuffledHashJoin(skew=true)" in text
    got = df.count()
    # The merge also returns lookup keys that no row has.
    extra = 0 if name != "full" else lookup.where("k like 'k%'").join(big_skew, ["k"], "left_anti").count()
    assert got == n + extra


def test_marks_of_missing_and_hot_keys_are_split_at_run_time(spark, small_limits, big_skew):
    df = first.mark_duplicates(big_skew, ["k"], "again", known_flag="again_known")
    text = final_plan(df)
    assert "(skew=true)" in text and text.count("SortMergeJoin") + text.count("ShuffledHashJoin") == 1
    counted = df.groupBy(F.col("k").isNull().alias("missing")).agg(F.count_if("again"), F.count_if("again_known"))
    assert {tuple(r) for r in counted.collect()} == {(True, 40_000, 0), (False, 80_000, 80_000)}


def test_top_k_on_double_sums_keeps_its_rows(spark):
    rows = spark.range(30_000).select((F.col("id") % 40).alias("g"), (F.col("id") % 1000 / 3.0).alias("v"))
    got = []
    for n in (1, 7, 64):
        totals = rows.repartition(n).groupBy("g").agg(F.sum("v").alias("total")).withColumn("one", F.lit(1))
        got.append(first.top_k_with_ties(totals, ["one"], ["-total"], 5).count())
    assert min(got) >= 5


def test_hot_cell_is_split_at_run_time(spark, small_limits):
    from tracewater.operators.spatial import points_in_polygons

    spread = F.pmod(F.xxhash64("id"), F.lit(4000)).cast("double")
    points = spark.range(0, 60_000, 1, 16).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(spread).alias("px"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(spread * 7, F.lit(4000.0))).alias("py"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    area = spark.range(1).select(
        F.lit("a").alias("plant"), F.array(F.array(corner(0, 0), corner(10, 0), corner(10, 10), corner(0, 10))).alias("rings")
    )
    df = points_in_polygons(points, "px", "py", area, "rings", ["plant"], 100.0)
    assert "(skew=true)" in final_plan(df)
    inside = points.where("px between 0 and 10 and py between 0 and 10").count()
    assert df.count() == inside >= 20_000
