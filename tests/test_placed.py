"""Features laid out by place and read within a box, against a filter over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from tracewater.sources import placed

SCHEMA = "id int, min_x double, min_y double, max_x double, max_y double"


def boxes(n, seed=5):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        x, y, w = draw.uniform(-500, 500), draw.uniform(0, 300), draw.choice([0, 1, 1, 2, 2, 200])
        out.append((i, x, y, x + w, y + w / 2))
    return [*out, *[(n + i, 5.0, 5.0, 6.0, 6.0) for i in range(300)]]  # one crowded place


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    odd = [(-1, None, 0.0, 1.0, 1.0), (-2, 0.0, 0.0, float("inf"), 1.0), (-3, float("nan"), 0.0, 1.0, 1.0), (-4, 0.0, 0.0, 1.0, float("nan"))]
    rows = boxes(3000)
    folder = str(tmp_path_factory.mktemp("placed") / "areas")
    placed.land_by_place(spark.createDataFrame([*rows, *rows[:2], *odd], SCHEMA), folder, rows_per_file=100)
    return folder, [*rows, *rows[:2]], odd


def test_code_takes_bits_in_turn(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (3, 5), (2**16 - 1, 0), (2**16 - 1, 2**16 - 1), (40_000, 12_345)]
    got = spark.createDataFrame(pairs, "x bigint, y bigint").select("x", "y", placed.morton_code(F.col("x"), F.col("y")).alias("code"))
    for x, y, code in got.collect():
        assert code == int("".join(a + b for a, b in zip(f"{x:016b}", f"{y:016b}", strict=True)), 2)


@pytest.mark.parametrize("box", [(0, 0, 20, 20), (-500, 0, -480, 10), (-1e9, -1e9, 1e9, 1e9), (6, 6, 6, 6), (250.5, 100, 250.6, 290), (900, 900, 950, 950)])
def test_box_gives_what_a_filter_gives(spark, landed, box):
    folder, rows, _ = landed
    x0, y0, x1, y1 = box
    want = sorted(r[0] for r in rows if r[1] <= x1 and r[3] >= x0 and r[2] <= y1 and r[4] >= y0)
    got = placed.features_in_box(spark, folder, box)
    assert sorted(r.id for r in got.collect()) == want
    assert sorted(r.id for r in placed.features_in_box(spark, folder, box, most_files=1).collect()) == want


def test_only_touched_files_are_opened(spark, landed, capsys):
    folder, rows, odd = landed
    whole = spark.read.parquet(f"{folder}/features")
    assert whole.count() == len(rows) + len(odd)
    files = len(whole.inputFiles())
    assert 30 <= files <= 45
    near = placed.features_in_box(spark, folder, (-400, 100, -390, 110))
    assert 0 < len(near.inputFiles()) < files / 2 and near.count() > 0
    spread = spark.read.parquet(f"{folder}/boxes").agg(F.avg("n_rows"), F.expr("avg((max_x - min_x) * (max_y - min_y))")).first()
    assert spread[0] > 80 and spread[1] < 1000 * 500 / 4  # a file has a small part of the area on average, not all of it
    near.explain("formatted")
    pushed = capsys.readouterr().out.split("PushedFilters:")[1].splitlines()[0]
    assert all(f in pushed for f in ("LessThanOrEqual(min_x,-390.0)", "GreaterThanOrEqual(max_x,-400.0)", "LessThanOrEqual(min_y,110.0)"))


def test_overall_box_of_a_frame_and_empty_ones(spark, landed, tmp_path):
    folder, rows, _ = landed
    area = spark.createDataFrame([(1, 0.0, 0.0, 3.0, 3.0), (2, 10.0, 10.0, 20.0, 20.0), (3, None, None, None, None)], SCHEMA)
    want = sorted(r[0] for r in rows if r[1] <= 20 and r[3] >= 0 and r[2] <= 20 and r[4] >= 0)
    assert sorted(r.id for r in placed.features_in_box(spark, folder, area).collect()) == want
    assert placed.features_in_box(spark, folder, area.where("id = 3")).count() == 0
    none = placed.land_by_place(area.where("id > 9").withColumn("a.b", F.create_map(F.lit("k"), "id")), str(tmp_path / "none"))
    assert placed.features_in_box(spark, none, (0, 0, 1, 1)).columns == [*area.columns, "a.b"]
    assert placed.features_in_box(spark, none, (0, 0, 1, 1)).count() == 0
