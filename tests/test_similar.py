"""Near texts and address suggestions against plain edit distances."""

import random

import pytest
from pyspark.sql import functions as F

from tracewater.operators import similar
from tracewater.plans import places


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(seed, count):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abé") for _ in range(rnd.randint(0, 6))) for _ in range(count)]


@pytest.mark.parametrize("edits", [1, 2])
def test_near_texts_against_edit_distances(spark, edits):
    left, right = words(1, 120), words(2, 120)
    a = spark.createDataFrame([(w, 1) for w in [*left, None]], "t string, n int")
    b = spark.createDataFrame([(w,) for w in [*right, None]], "s string")
    got = [tuple(r) for r in similar.near_texts(a, "t", b, "s", edits).collect()]
    want = {(x, y, distance(x, y)) for x in left for y in right if distance(x, y) <= edits}
    assert len(got) == len(set(got)) and set(got) == want
    assert similar.near_texts(a.limit(0), "t", b, "s", edits).count() == 0


def test_a_hot_neighbourhood_keeps_every_pair(spark):
    known = [f"Street {i:02d} x" for i in range(100)]
    a = spark.createDataFrame([("Street 5 x",)], "t string")
    got = similar.suggestions(a, "t", spark.createDataFrame([(k,) for k in known], "s string"), "s").collect()
    want = sorted((distance("Street 5 x", k), k) for k in known if distance("Street 5 x", k) <= 1)
    assert [(r.distance, r.suggestion) for r in sorted(got, key=lambda r: r["rank"])] == want and not any(r.only for r in got)


def test_suggestions_for_missed_addresses(spark):
    register = spark.createDataFrame(
        [("Dam 1, Amsterdam", 52.0, 4.9), ("Dam 2, Amsterdam", 52.1, 4.9), ("Markt 10, Delft", 52.0, 4.3)],
        "address string, latitude double, longitude double",
    )
    asked = spark.createDataFrame([("dam 1 ,Amsterdam",), ("Dan 1, Amsterdam",), ("Mrkt 10, Delft",), ("Far, Away",), (None,)], "address string")
    found = places.address_suggestions(places.locate(asked, register), register, edits=2).collect()
    got = sorted((r.address, r["rank"], r.suggestion, r.distance, r.only) for r in found)
    assert got == [
        ("DAN 1, AMSTERDAM", 1, "DAM 1, AMSTERDAM", 1, True), ("DAN 1, AMSTERDAM", 2, "DAM 2, AMSTERDAM", 2, False),
        ("MRKT 10, DELFT", 1, "MARKT 10, DELFT", 1, True),
    ]


def test_texts_spread_into_remainders_are_not_broadcast(spark):
    """Each text of 28 characters becomes 407 rows, so a small list is no small join side."""
    known = spark.range(3000).select(F.format_string("CUSTOMER#%09d, MACHINERY", "id").alias("s"))
    asked = known.limit(20).select(F.replace("s", F.lit("OMER"), F.lit("OMR")).alias("t"))
    near = similar.near_texts(asked, "t", known, "s", 2)
    rows = near.count()
    plan = near._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "__key" in line and "Join" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    want = sum(distance(f"CUSTOMR#{i:09d}", f"CUSTOMER#{j:09d}") <= 2 for i in range(20) for j in range(3000))
    assert rows == want
