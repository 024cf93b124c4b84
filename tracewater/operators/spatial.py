"""Spatial joins on an index of grid cells.

A polygon is ``array<array<struct<x,y>>>``: all rings of all its parts, each
closed or open. Inside is decided by the even-odd rule over all rings, so
holes and several parts need no special case. Boundaries belong to the
polygon: touching counts.

A polygon is laid on a square grid once. Each cell that an edge passes gets
that edge, and each cell knows whether its lower left corner lies inside, which
follows from a scanline fill: where a grid line crosses the edges, the corners
between the first and the second crossing are inside, and so on. Cells inside
without an edge are kept as marks. A point is then judged by its cell alone:
from the corner up to the point's height and across to the point, every edge
passed changes sides, and all such edges are in the cell. So the index has as
many rows as cells and pieces of edges, geometry is never copied to other
cells, and the polygon's own columns are joined back by id at the end.

Polygons meet if edges of both meet in a shared cell, or a ring of one starts
inside the other. A crowded cell is an ordinary hot join key, which AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.session import shared_folder

BOX = ("min_x", "min_y", "max_x", "max_y")
PAIRS_OF_A_TASK = 2_000_000


# The predicates are SQL text over column or field names, one expression each:
# lambdas over edge arrays read better there than as nested Column calls.


def edges_of(rings: str) -> Column:
    """``array<struct<x1,y1,x2,y2>>`` over all rings; open rings are closed."""
    return F.expr(
        f"""flatten(transform({rings}, r -> zip_with(
              r, concat(slice(r, 2, greatest(size(r) - 1, 0)), slice(r, 1, 1)),
              (a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))))"""
    )


def with_box(df: DataFrame, rings: str) -> DataFrame:
    """Add the bounding box columns of a polygon column."""

    def bound(fn: str, axis: str) -> Column:
        return F.expr(f"{fn}(transform(flatten({rings}), p -> p.{axis}))")

    return df.withColumns(
        {
            "min_x": bound("array_min", "x"), "min_y": bound("array_min", "y"),
            "max_x": bound("array_max", "x"), "max_y": bound("array_max", "y"),
        }
    )


def within_box(points: DataFrame, x: str, y: str, area: DataFrame) -> DataFrame:
    """Points inside the overall bounding box of ``area`` (a frame with box columns).

    The four bounds are scalar subqueries, so they reach the scan as filters.
    """
    bound = {
        "min_x": area.select(F.min("min_x")).scalar(),
        "min_y": area.select(F.min("min_y")).scalar(),
        "max_x": area.select(F.max("max_x")).scalar(),
        "max_y": area.select(F.max("max_y")).scalar(),
    }
    return points.where(
        (F.col(x) >= bound["min_x"])
        & (F.col(x) <= bound["max_x"])
        & (F.col(y) >= bound["min_y"])
        & (F.col(y) <= bound["max_y"])
    )


def _cross(e: str, x: str, y: str) -> str:
    """Side of edge ``e`` on which the point lies: its sign, zero on the line."""
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def covers_sql(cell: str, x: str, y: str, left: str) -> str:
    """Whether the polygon covers the point, boundary included, by the point's cell, whose left side is ``left``.

    ``{cell}edges`` are the upward edges in the cell, ``{cell}inside`` says
    whether its corner is inside. The point counts as a hair to the right and
    less than that up, so no edge is met at its end. An edge that spans a
    height is never level, so its division is safe.
    """
    up = f"e.past <> {_past('e', left, y)}"
    across = f"""e.y1 <= {y} AND e.y2 > {y} AND {x} >= (e.x2 - e.x1) * ({y} - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
            AND {_cross("e", left, y)} > 0"""
    return f"""((int({cell}inside) + size(filter({cell}edges, e -> {up})) + size(filter({cell}edges, e -> {across}))) % 2 = 1
        OR exists({cell}edges, e -> {y} BETWEEN e.y1 AND e.y2 AND {_cross("e", x, y)} = 0
            AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)))"""


def _past(e: str, x: str, y: str) -> str:
    """On which of its sides a point on the vertical ``x``, which the upward edge ``e`` crosses, has that edge."""
    return f"IF({e}.y1 = {e}.y2, {y} >= {e}.y1, {_cross(e, x, y)} > 0)"


def edges_meet_sql(a: str, b: str) -> str:
    """Whether two closed segments share a point."""
    boxes = " AND ".join(
        f"least({p}.{v}1, {p}.{v}2) <= greatest({q}.{v}1, {q}.{v}2)" for v in "xy" for p, q in ((a, b), (b, a))
    )
    sides = " AND ".join(
        f"signum({_cross(p, f'{q}.x1', f'{q}.y1')}) * signum({_cross(p, f'{q}.x2', f'{q}.y2')}) <= 0"
        for p, q in ((a, b), (b, a))
    )
    return f"({boxes} AND {sides})"


def cell_index(polygons: DataFrame, key: str, rings: str, size: float) -> DataFrame:
    """``key, cx, cy, edges, inside, box``: what each grid cell knows of each polygon.

    Rows with one ``key`` must be copies of one polygon. One shuffle by
    (polygon, grid row); within a row the corners' sides follow from the sorted
    crossings of the row's lower line.
    """
    s = f"{float(size)!r}D"
    boxed = with_box(polygons.select(F.col(key).alias("__key"), F.col(rings).alias("__rings")), "__rings")
    upward = "IF(e.y1 <= e.y2, e, named_struct('x1', e.x2, 'y1', e.y2, 'x2', e.x1, 'y2', e.y1))"
    edges = boxed.select("__key", F.struct(*BOX).alias("box"), F.posexplode(edges_of("__rings")).alias("n", "e")).withColumn("e", F.expr(upward))
    bands = edges.withColumn("cy", F.expr(f"explode(sequence(floor(e.y1 / {s}), floor(e.y2 / {s})))"))
    # Where the edge runs within the grid row, a little wider than it is: an edge too many in a cell does no harm.
    at = "e.x1 + (least(greatest({}, e.y1), e.y2) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)"
    ends = [at.format(f"cy * {s}"), at.format(f"(cy + 1) * {s}")]
    reach = {
        "x0": F.expr(f"CASE WHEN e.y1 = e.y2 THEN least(e.x1, e.x2) ELSE least({', '.join(ends)}) END"),
        "x1": F.expr(f"CASE WHEN e.y1 = e.y2 THEN greatest(e.x1, e.x2) ELSE greatest({', '.join(ends)}) END"),
    }
    low = f"cy * {s}"
    spans = f"e.y1 <= {low} AND e.y2 > {low}"
    near = f"floor((e.x1 + ({low} - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0)) / {s})"
    # How far corners have the edge to their right: the division tells it to about a cell, the side of the corner exactly.
    tries = " ".join(f"WHEN {_cross('e', f'(near + {k}) * {s}', low)} > 0 THEN near + {k} + 1" for k in (1, 0, -1))
    placed = bands.withColumns(reach).withColumn("near", F.expr(near)).select(
        "__key", "cy", "box",
        F.struct(
            "n",
            "e",
            F.expr(f"floor(x0 / {s} - 1e-9D)").alias("c0"),
            F.expr(f"floor(x1 / {s} + 1e-9D)").alias("c1"),
            F.expr(f"CASE WHEN {spans} THEN CASE {tries} ELSE near - 1 END END").alias("k"),
        ).alias("piece"),
    )
    # A set, by the edge's place in the polygon: copies of a polygon count once.
    per_row = placed.groupBy("__key", "cy").agg(F.first("box").alias("box"), F.collect_set("piece").alias("pieces"))
    crossings = "array_sort(filter(transform(pieces, p -> p.k), k -> k IS NOT NULL))"
    runs = """filter(transform(filter(sequence(0, greatest(size(ks) - 2, 0)), i -> i % 2 = 0 AND i + 1 < size(ks)),
        i -> named_struct('a', ks[i], 'b', ks[i + 1] - 1)), r -> r.a <= r.b)"""
    # An edge that crosses the cell's left side knows which side of it the corner is on.
    left = f"(c * {s})"
    past = f"IF((p.e.x1 > {left}) <> (p.e.x2 > {left}), {_past('p.e', left, low)}, NULL)"
    edge = f"named_struct('x1', p.e.x1, 'y1', p.e.y1, 'x2', p.e.x2, 'y2', p.e.y2, 'past', {past})"
    cells = f"""concat(
        flatten(transform(pieces, p -> transform(sequence(p.c0, p.c1), c -> named_struct('cx', c, 'e', {edge}, 'inside', false)))),
        flatten(transform(runs, r -> transform(sequence(r.a, r.b), c -> named_struct('cx', c, 'e', CAST(NULL AS struct<x1: double, y1: double, x2: double, y2: double, past: boolean>), 'inside', true)))))"""
    spelled = per_row.withColumn("ks", F.expr(crossings)).withColumn("runs", F.expr(runs)).select(
        "__key", "cy", "box", F.explode(F.expr(cells)).alias("c")
    )
    return spelled.groupBy(F.col("__key").alias(key), "cy", F.col("c.cx").alias("cx")).agg(
        F.collect_list("c.e").alias("edges"), F.max("c.inside").alias("inside"), F.first("box").alias("box")
    )


def _keyed(df: DataFrame, keep: Sequence[str], rings: str) -> DataFrame:
    """``keep``, the rings and a 128-bit key of both."""
    content = [*keep, rings]
    return df.select(*keep, F.col(rings).alias("__rings"), F.struct(F.xxhash64(*content), F.xxhash64(F.lit(1), *content)).alias("__id"))


def _found(points: DataFrame, x: str, y: str, index: DataFrame, size: float, also: Column | None = None) -> DataFrame:
    """``points`` with the ``__id`` of every polygon of the index that covers them; ``also`` is a further join condition."""
    s = f"{float(size)!r}D"
    cells = index.select("__id", *[F.col(c).alias(f"__{c}") for c in ("cx", "cy", "edges", "inside", "box")])
    placed = points.withColumns({"__px": F.expr(f"floor({x} / {s})"), "__py": F.expr(f"floor({y} / {s})")})
    same_cell = (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy"))
    met = placed.join(cells, same_cell if also is None else same_cell & also)
    in_box = F.expr(f"{x} BETWEEN __box.min_x AND __box.max_x AND {y} BETWEEN __box.min_y AND __box.max_y")
    covered = F.expr(covers_sql("__", x, y, f"(__cx * {s})"))
    return met.where(in_box).where((F.size("__edges") == 0) | covered).select(*points.columns, "__id")


def _refined(index: DataFrame, size: float, parts: int) -> DataFrame:
    """``__id, __level, __cx, __cy, __inside, __edges``: the index with crossed cells cut into ``parts`` x ``parts``, a power of 2.

    Level 0 holds the whole cells that are inside without an edge, level 1 the
    parts of the others, but for those outside. Most parts have one or two
    edges, and there are at most ``parts`` squared for each cell of the index.
    A part's corner follows from the cell's corner as a point does: up the
    cell's side to the part's row, and across to the part.
    """
    s, f = f"{float(size)!r}D", f"{float(size) / parts!r}D"
    side, left, low, high = f"(cx * {s})", f"(px * {f})", f"(py * {f})", f"((py + 1) * {f})"
    rows = index.withColumn("row", F.explode(F.expr(f"IF(size(edges) = 0, array(-1), sequence(0, {parts - 1}))")))
    rows = rows.withColumn("py", F.expr(f"cy * {parts} + row"))
    at = [f"e.x1 + (least(greatest({h}, e.y1), e.y2) - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)" for h in (low, high)]
    met = f"""transform(filter(edges, e -> floor(e.y1 / {f}) <= py AND floor(e.y2 / {f}) >= py), e -> named_struct('e', e,
        'c0', floor(IF(e.y1 = e.y2, least(e.x1, e.x2), least({at[0]}, {at[1]})) / {f} - 1e-9D),
        'c1', floor(IF(e.y1 = e.y2, greatest(e.x1, e.x2), greatest({at[0]}, {at[1]})) / {f} + 1e-9D),
        'spans', e.y1 <= {low} AND e.y2 > {low} AND {_cross('e', side, low)} > 0))"""
    up = f"e.past <> {_past('e', side, low)}"
    rows = rows.withColumns({"met": F.expr(met), "up": F.expr(f"IF(row < 0, 0, int(inside) + size(filter(edges, e -> {up})))")})
    cut = rows.withColumn("column", F.explode(F.expr(f"IF(row < 0, array(0), sequence(0, {parts - 1}))")))
    cut = cut.withColumn("px", F.expr(f"cx * {parts} + column"))
    across = f"m.spans AND NOT {_cross('m.e', left, low)} > 0"
    past = f"IF((m.e.x1 > {left}) <> (m.e.x2 > {left}), {_past('m.e', left, low)}, NULL)"
    kept = f"""transform(filter(met, m -> m.c0 <= px AND m.c1 >= px), m ->
        named_struct('x1', m.e.x1, 'y1', m.e.y1, 'x2', m.e.x2, 'y2', m.e.y2, 'past', {past}))"""
    split = cut.select(
        "__id", F.expr("int(row >= 0)").alias("__level"),
        F.expr("IF(row < 0, cx, px)").alias("__cx"), F.expr("IF(row < 0, cy, py)").alias("__cy"),
        F.expr(f"IF(row < 0, inside, (up + size(filter(met, m -> {across}))) % 2 = 1)").alias("__inside"),
        F.expr(f"IF(row < 0, edges, {kept})").alias("__edges"),
    )
    return split.where(F.col("__inside") | (F.size("__edges") > 0))


def _plain_edge(n: int) -> dict[str, Column]:
    """Edge ``n`` of ``__edges`` as columns without nulls; one that is missing is passed by no point."""
    e = f"get(__edges, {n})"
    beyond = "double('infinity')"
    return {
        f"__x1_{n}": F.expr(f"coalesce({e}.x1, 0D)"), f"__y1_{n}": F.expr(f"coalesce({e}.y1, {beyond})"),
        f"__x2_{n}": F.expr(f"coalesce({e}.x2, 0D)"), f"__y2_{n}": F.expr(f"coalesce({e}.y2, {beyond})"),
        f"__past_{n}": F.expr(f"coalesce(int({e}.past), -1)"),
    }


def _covers_few_sql(x: str, y: str, left: str, few: int) -> str:
    """As ``covers_sql`` for a cell with at most ``few`` edges, given by ``_plain_edge``, without a loop over an array."""
    turns, on = [], []
    for n in range(few):
        x1, y1, x2, y2 = (f"__{c}_{n}" for c in ("x1", "y1", "x2", "y2"))
        at_left = f"({x2} - {x1}) * ({y} - {y1}) > ({y2} - {y1}) * ({left} - {x1})"
        turns.append(f"int(__past_{n} >= 0 AND __past_{n} <> int(IF({y1} = {y2}, {y} >= {y1}, {at_left})))")
        turns.append(f"int({y1} <= {y} AND {y2} > {y} AND {x} >= ({x2} - {x1}) * ({y} - {y1}) / IF({y1} = {y2}, 1D, {y2} - {y1}) + {x1} AND {at_left})")
        on.append(
            f"""({y} >= {y1} AND {y} <= {y2} AND ({x2} - {x1}) * ({y} - {y1}) = ({y2} - {y1}) * ({x} - {x1})
            AND {x} >= least({x1}, {x2}) AND {x} <= greatest({x1}, {x2}))"""
        )
    return f"((int(__inside) + {' + '.join(turns)}) % 2 = 1 OR {' OR '.join(on)})"


def points_in_polygons(
    points: DataFrame, x: str, y: str, polygons: DataFrame, rings: str, keep: Sequence[str], cell: float
) -> DataFrame:
    """Each point with every polygon that covers it; ``keep`` names polygon columns to return.

    A point lies in one cell and in one part of it, so each pair meets once.
    Pairs may be far more than points and polygons: ``keep`` goes along with
    the index, so no pair is shuffled, and few pairs need a loop over edges.
    """
    parts, few = 8, 2
    s, f = f"{float(cell)!r}D", f"{float(cell) / parts!r}D"
    areas = _keyed(polygons, keep, rings)
    index = _refined(cell_index(areas, "__id", "__rings", cell), cell, parts)
    named = areas.select("__id", F.struct(F.lit(0).alias("__none"), *keep).alias("__keep"))
    edges = {name: value for n in range(few) for name, value in _plain_edge(n).items()}
    cells = index.join(named, "__id").withColumns({"__n": F.size("__edges"), **edges}).withColumn(
        "__edges", F.when(F.col("__n") > few, F.col("__edges"))
    )
    at = [f"named_struct('level', {n}, 'x', floor({x} / {d}), 'y', floor({y} / {d}))" for n, d in enumerate((s, f))]
    known = points.where(F.expr(f"NOT isnan({x}) AND NOT isnan({y})"))
    placed = known.withColumn("__at", F.explode(F.expr(f"array({', '.join(at)})"))).select(
        *points.columns, F.col("__at.level").alias("__pl"), F.col("__at.x").alias("__px"), F.col("__at.y").alias("__py")
    )
    same = (F.col("__pl") == F.col("__level")) & (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy"))
    left = f"(__cx * {f})"
    covered = f"CASE WHEN __n = 0 THEN true WHEN __n <= {few} THEN {_covers_few_sql(x, y, left, few)} ELSE {covers_sql('__', x, y, left)} END"
    met = placed.join(cells.drop("__id"), same).where(F.expr(covered))
    return met.select(*points.columns, *[F.col("__keep")[c].alias(c) for c in keep])


def cells_of(keyed: DataFrame, index: DataFrame, items: Column, keep: Sequence[str], *more: Column) -> DataFrame:
    """The index with ``items``, the columns to keep and whether the polygon has no other cell, written to the shared folder."""
    from tracewater.sources.sinks import write_stage  # which imports this module

    spark = keyed.sparkSession
    index = index.select("__id", "cx", "cy", "box", items.alias("items"), *more).where(F.size("items") > 0)
    rows = write_stage(index, shared_folder(spark, "cells"))
    own = rows.groupBy("__id").agg((F.count_distinct("cx", "cy") == 1).alias("single"))
    kept = F.struct(F.lit(0).alias("__none"), *keep).alias("keep")
    named = own.join(keyed.dropDuplicates(["__id"]).select("__id", kept), "__id")
    return write_stage(rows.join(named, "__id"), shared_folder(spark, "cells"))


def pairs_in_cells(a: DataFrame, b: DataFrame) -> tuple[list[DataFrame], DataFrame, int]:
    """Rows of both sides (see ``cells_of``) that share a cell and whose boxes meet, with ``__a_``, ``__b_`` before their names.

    First those of pairs that meet in one cell only, since one of both has no
    other, then the rest, and over how many tasks all pairs may be spread. Rows
    of a pair and cell are in one task, told by ``__z``, so they are grouped
    without a shuffle; a crowded cell is dealt to several tasks, by the left
    polygon. Merge joins, since written lists pack too well to be broadcast by
    their size.
    """
    from tracewater.sources.sinks import write_stage

    spark = a.sparkSession
    counts = [i.groupBy("cx", "cy").agg(F.count(F.lit(1)).cast("double").alias(n)) for i, n in ((a, "a"), (b, "b"))]
    crowd = write_stage(counts[0].join(counts[1], ["cx", "cy"]).withColumn("n", F.col("a") * F.col("b")), shared_folder(spark, "crowds"))
    offered = crowd.agg(F.sum("n")).first()[0] or 0.0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(offered / PAIRS_OF_A_TASK) + 1)
    dealt = crowd.select("cx", "cy", F.ceil(F.col("n") / PAIRS_OF_A_TASK).alias("deals"))
    left = a.join(dealt, ["cx", "cy"]).withColumn("deal", F.pmod(F.xxhash64("__id"), "deals"))
    right = b.join(dealt, ["cx", "cy"]).withColumn("deal", F.explode(F.expr("sequence(0L, deals - 1)")))

    def named(df: DataFrame, tag: str) -> DataFrame:
        df = df.withColumn("__z", F.xxhash64("cx", "cy", "deal")).drop("deal", "deals")
        return df.select("__z", *[F.col(c).alias(f"__{tag}_{c.strip('_')}") for c in df.columns if c != "__z"]).repartition(parts, "__z")

    boxes = " AND ".join(f"__{p}_box.min_{v} <= __{q}_box.max_{v}" for v in "xy" for p, q in (("a", "b"), ("b", "a")))
    same = "__a_cx - __b_cx = 0 AND __a_cy - __b_cy = 0"  # no further join keys: both sides are dealt by __z

    def met(which_a: Column, which_b: Column) -> DataFrame:
        return named(left.where(which_a), "a").hint("merge").join(named(right.where(which_b), "b"), "__z").where(F.expr(f"{same} AND {boxes}"))

    single, every = F.col("single"), F.lit(True)
    return [met(single, every), met(~single, single)], met(~single, ~single), parts


def _flips_sql(e: str, p: str, left: str) -> str:
    """Whether an edge of a cell changes sides on the way from the cell's corner to a point, as ``covers_sql`` goes.

    Both are prefixes of plain columns; an edge's ``past`` is -1 where it does not cross the cell's left side.
    """
    x1, y1, x2, y2 = (f"{e}{c}" for c in ("x1", "y1", "x2", "y2"))
    x, y = f"{p}x1", f"{p}y1"
    at_left = f"({x2} - {x1}) * ({y} - {y1}) > ({y2} - {y1}) * ({left} - {x1})"
    up = f"({e}past >= 0 AND {e}past <> int(IF({y1} = {y2}, {y} >= {y1}, {at_left})))"
    across = f"({y1} <= {y} AND {y2} > {y} AND {x} >= ({x2} - {x1}) * ({y} - {y1}) / IF({y1} = {y2}, 1D, {y2} - {y1}) + {x1} AND {at_left})"
    return f"({up} <> {across})"


def _sides_sql(a: str, b: str) -> str:
    """Whether two closed segments whose boxes meet share a point; both are prefixes of plain columns."""

    def side(e: str, x: str, y: str) -> str:
        return f"signum(({e}x2 - {e}x1) * ({y} - {e}y1) - ({e}y2 - {e}y1) * ({x} - {e}x1))"

    return " AND ".join(f"{side(p, f'{q}x1', f'{q}y1')} * {side(p, f'{q}x2', f'{q}y2')} <= 0D" for p, q in ((a, b), (b, a)))


STARTS = 60  # bits for the starts of a polygon's rings in a cell; more take further rows


def _meeting_cells(df: DataFrame, rings: str, keep: Sequence[str], size: float) -> DataFrame:
    """Cells of polygons with ``items``: edges (kind 0), the corner if it is inside (1) and where rings start (2)."""
    keyed = _keyed(df, keep, rings)
    s = f"{float(size)!r}D"
    starts = keyed.select("__id", F.explode(F.expr("transform(filter(__rings, r -> size(r) > 0), r -> r[0])")).alias("p"))
    starts = starts.groupBy("__id", F.expr(f"floor(p.x / {s})").alias("cx"), F.expr(f"floor(p.y / {s})").alias("cy")).agg(F.collect_set("p").alias("starts"))
    index = cell_index(keyed, "__id", "__rings", size).join(starts, ["__id", "cx", "cy"], "left")
    index = index.withColumn("starts", F.coalesce("starts", F.expr("slice(array(named_struct('x', 0D, 'y', 0D)), 1, 0)")))
    index = index.withColumn("nth", F.explode(F.expr(f"sequence(0, greatest(int(ceil(size(starts) / {STARTS})) - 1, 0))")))
    item = "named_struct('kind', {}, 'bit', {}, 'x1', {}, 'y1', {}, 'x2', {}, 'y2', {}, 'past', {})"
    no = "CAST(NULL AS boolean)"
    edges = f"transform(edges, e -> {item.format(0, '0L', 'e.x1', 'e.y1', 'e.x2', 'e.y2', 'e.past')})"
    mark = f"array({item.format(1, '0L', '0D', '0D', '0D', '0D', no)})"
    points = f"transform(slice(starts, nth * {STARTS} + 1, {STARTS}), (p, i) -> {item.format(2, 'shiftleft(1L, i)', 'p.x', 'p.y', 'p.x', 'p.y', no)})"
    items = F.expr(f"concat(IF(nth = 0, {edges}, slice({edges}, 1, 0)), IF(nth = 0 AND inside, {mark}, slice({mark}, 1, 0)), {points})")
    return cells_of(keyed, index, items, keep, F.col("nth"))


def polygons_meeting(
    left: DataFrame, left_rings: str, left_keep: Sequence[str],
    right: DataFrame, right_rings: str, right_keep: Sequence[str],
    cell: float,
) -> DataFrame:
    """Pairs of polygons that overlap or touch, as distinct ``left_keep`` + ``right_keep``.

    Pairs may be far more than polygons. The columns to keep go along with the
    indexes, which are written to the shared folder. Within a cell each edge of
    one meets each edge of the other, and the edges and the corner passed on
    the way to a ring's start are counted, a bit for each start; both are plain
    rows, without a loop over arrays in an expression. Pairs of which one
    polygon has a single cell are found there once and for all; only the others
    are shuffled, to be made distinct.
    """
    a, b = _meeting_cells(left, left_rings, left_keep, cell), _meeting_cells(right, right_rings, right_keep, cell)
    # Pairs of polygons are pairs of what is kept, unless different polygons keep the same or a cell takes several rows.
    plain = all(
        i.agg(F.count_distinct("__id") == F.count_distinct(F.struct("keep")), F.coalesce(F.max("nth"), F.lit(0)) == 0).first() == (True, True) for i in (a, b)
    )
    local, spread, parts = pairs_in_cells(a, b)
    corner = f"(__a_cx * {float(cell)!r}D)"
    edges = "__p.kind = 0 AND __q.kind = 0 AND __p.y1 <= __q.y2 AND __q.y1 <= __p.y2"  # lower ends come first
    spans = " AND ".join(f"least(__{p}.x1, __{p}.x2) <= greatest(__{q}.x1, __{q}.x2)" for p, q in (("p", "q"), ("q", "p")))
    starts = " OR ".join(
        f"(__{p}.kind = 2 AND __{q}.kind < 2 AND __{p}.x1 BETWEEN __{o}_box.min_x AND __{o}_box.max_x AND __{p}.y1 BETWEEN __{o}_box.min_y AND __{o}_box.max_y)"
        for p, q, o in (("p", "q", "b"), ("q", "p", "a"))
    )
    # Plain columns without nulls, and no condition on what is worked out of them: the code for a row stays small enough to be compiled.
    ends = {"x1": "0D", "y1": "0D", "x2": "0D", "y2": "0D", "kind": "0", "bit": "0L"}
    plainly = {f"__{p}_{c}": F.expr(f"coalesce(__{p}.{c}, {none})") for p in "pq" for c, none in ends.items()}
    plainly |= {f"__{p}_past": F.expr(f"coalesce(int(__{p}.past), -1)") for p in "pq"}

    def bit(p: str, q: str) -> str:
        return f"IF(__{p}_kind = 2 AND __{q}_kind < 2 AND (__{q}_kind = 1 OR {_flips_sql(f'__{q}_', f'__{p}_', corner)}), __{p}_bit, 0L)"

    def found(met: DataFrame) -> DataFrame:
        each = met.withColumn("__p", F.explode("__a_items")).withColumn("__q", F.explode("__b_items"))
        told = each.where(F.expr(f"({edges} AND {spans}) OR {starts}")).withColumns(plainly).withColumns({
            "__meets": F.expr(f"IF(__p_kind = 0 AND __q_kind = 0 AND {_sides_sql('__p_', '__q_')}, 1, 0)"),
            "__in_b": F.expr(bit("p", "q")), "__in_a": F.expr(bit("q", "p")),
        })
        keys = ["__z", "__a_id", "__b_id", "__a_nth", "__b_nth", "__a_keep", "__b_keep"]
        by_cell = told.groupBy(*keys).agg(F.max("__meets").alias("m"), F.bit_xor("__in_a").alias("a"), F.bit_xor("__in_b").alias("b"))
        return by_cell.where("m = 1 OR a <> 0 OR b <> 0").select(
            *[F.col("__a_keep")[c].alias(c) for c in left_keep], *[F.col("__b_keep")[c].alias(c) for c in right_keep]
        )

    once, again = found(local[0]).unionByName(found(local[1])), found(spread)
    if not plain:
        once, again = None, again.unionByName(once)
    again = again.repartition(parts, *again.columns).distinct()
    return again if once is None else once.unionByName(again)
