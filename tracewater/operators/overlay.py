"""What polygons have in common, as pieces with an area, worked out cell by cell on the cell index.

Two polygons meet in the grid cells that both know. Within a cell, the heights
where an edge starts, ends, meets another edge or leaves the cell cut it into
slabs in which no two edges change their order. So along the middle of a slab
one walk from the left side, with the sides of both polygons known there, gives
the stretches inside both, and each is a trapezoid between two edges. A
trapezoid's area is its middle width times its height, without error from the
shape, and boundaries that run along each other only make slabs or trapezoids
of no width. Nothing needs the direction of rings or the order of holes.

Of two polygons only the edges that reach into the box common to both cut
slabs, and only within its heights: what is left or right of it changes no side
within it, and nothing above or below it is shared.

Work and memory of a row grow with the edges of one cell, cubed at worst, not
with the polygons; the caller chooses cells so small that few edges pass each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.operators.spatial import _cross, _keyed, _past, cell_index, cells_of, pairs_in_cells

_PIECE = "struct<y0: double, y1: double, l0: double, l1: double, r0: double, r1: double, area: double>"


def _pieces_sql(sides: Sequence[str], size: float) -> str:
    """Trapezoids of the row's cell that lie in every side; ``sides`` are prefixes of ``edges``, ``inside`` and ``box`` columns."""
    s = f"{float(size)!r}D"
    left, right = f"(cx * {s})", f"((cx + 1) * {s})"
    low = f"greatest(cy * {s}, {', '.join(f'{p}box.min_y' for p in sides)})"
    high = f"least((cy + 1) * {s}, {', '.join(f'{p}box.max_y' for p in sides)})"
    reach = " AND ".join(
        f"greatest(e.{v}1, e.{v}2) >= {p}box.min_{v} AND least(e.{v}1, e.{v}2) <= {p}box.max_{v}" for p in sides for v in "xy"
    )
    # The edges and the two ends are bound once, as the only element of an array.
    edges = "filter(concat(" + ", ".join(f"{p}edges" for p in sides) + f"), e -> {reach})"
    at_side = "e.y1 + ({} - e.x1) * (e.y2 - e.y1) / nullif(e.x2 - e.x1, 0)"
    turn = "((e.x2 - e.x1) * (f.y2 - f.y1) - (e.y2 - e.y1) * (f.x2 - f.x1))"
    meeting = f"e.y1 + ((f.x1 - e.x1) * (f.y2 - f.y1) - (f.y1 - e.y1) * (f.x2 - f.x1)) / nullif({turn}, 0) * (e.y2 - e.y1)"
    cuts = f"""array_sort(array_distinct(filter(concat(array(b.low, b.high),
        flatten(transform(b.edges, e -> array(e.y1, e.y2, {at_side.format(left)}, {at_side.format(right)}))),
        flatten(transform(b.edges, e -> transform(b.edges, f -> {meeting})))), y -> y >= b.low AND y <= b.high)))"""
    heights = f"transform(array(named_struct('low', {low}, 'high', {high}, 'edges', {edges})), b -> {cuts})[0]"
    slabs = f"""transform(filter(sequence(1, greatest(size(hs) - 1, 1)), i -> i < size(hs)), i -> named_struct('lo', hs[i - 1], 'hi', hs[i], 'mid', (hs[i - 1] + hs[i]) / 2))"""

    def across(y: str) -> str:
        return f"least(greatest((e.x2 - e.x1) * ({y} - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1, {left}), {right})"

    def passed(p: str, n: int) -> str:
        """The side's edges to the right of the cell's left side, as ``m``, ``lo``, ``hi``: where they are at three heights."""
        met = f"filter({p}edges, e -> e.y1 <= t.mid AND e.y2 > t.mid AND {_cross('e', left, 't.mid')} > 0)"
        return f"transform({met}, e -> named_struct('m', {across('t.mid')}, 'lo', {across('t.lo')}, 'hi', {across('t.hi')}, 'k', {n}))"

    def at_left(p: str) -> str:
        return f"(int({p}inside) + size(filter({p}edges, e -> e.past <> {_past('e', left, 't.mid')}))) % 2 = 1"

    end = f"array(named_struct('m', {right}, 'lo', {right}, 'hi', {right}, 'k', {len(sides)}))"
    walk = "array_sort(concat(" + ", ".join([*[passed(p, n) for n, p in enumerate(sides)], end]) + "))"
    start = ", ".join(f"'s{n}', {at_left(p)}" for n, p in enumerate(sides))
    within = " AND ".join(f"w.s{n}" for n in range(len(sides)))
    piece = """named_struct('y0', t.lo, 'y1', t.hi, 'l0', w.lo, 'l1', w.hi, 'r0', x.lo, 'r1', x.hi, 'area', (x.m - w.m) * (t.hi - t.lo))"""
    step = ", ".join(f"'s{n}', w.s{n} <> (x.k = {n})" for n in range(len(sides)))
    found = f"""aggregate({walk},
        named_struct('m', {left}, 'lo', {left}, 'hi', {left}, {start}, 'out', CAST(array() AS array<{_PIECE}>)),
        (w, x) -> named_struct('m', x.m, 'lo', x.lo, 'hi', x.hi, {step},
            'out', IF({within} AND x.m > w.m, concat(w.out, array({piece})), w.out)),
        w -> w.out)"""
    # The heights are bound once, as the only element of an array.
    return f"flatten(flatten(transform(array({heights}), hs -> transform({slabs}, t -> {found}))))"


def _met(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """``__a, __b, pieces``: the trapezoids that a left and a right polygon share in one cell."""
    a, b = (
        cell_index(side, "__id", "__rings", size).select(
            F.col("__id").alias(f"__{p}"), "cx", "cy", *[F.col(c).alias(f"__{p}_{c}") for c in ("edges", "inside", "box")]
        )
        for p, side in (("a", left), ("b", right))
    )
    boxes = " AND ".join(f"__{p}_box.min_{v} <= __{q}_box.max_{v}" for v in "xy" for p, q in (("a", "b"), ("b", "a")))
    # Few and small rows make much work: unless spread, a few tasks would read whichever side is not broadcast.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = a.repartition(parts, "cx", "cy", "__a"), b.repartition(parts, "cx", "cy", "__b")
    pairs = a.join(b, ["cx", "cy"]).where(F.expr(boxes))
    return pairs.select("__a", "__b", F.expr(_pieces_sql(["__a_", "__b_"], size)).alias("pieces"))


_AREA = "sum(aggregate(pieces, 0D, (total, p) -> total + p.area))"


def polygon_areas(polygons: DataFrame, rings: str, keep: Sequence[str], cell: float) -> DataFrame:
    """Distinct ``keep`` + ``area`` by the even-odd rule: holes count as outside, whatever the direction of rings.

    A polygon without a ring of some area has no row.
    """
    keyed = _keyed(polygons, keep, rings)
    own = _own_areas(keyed, cell)
    return own.join(keyed.select("__id", *keep).distinct(), "__id").select(*keep, "area")


def _own_areas(keyed: DataFrame, cell: float) -> DataFrame:
    pieces = cell_index(keyed, "__id", "__rings", cell).select("__id", F.expr(_pieces_sql([""], cell)).alias("pieces"))
    return pieces.groupBy("__id").agg(F.expr(_AREA).alias("area")).where("area > 0")


def polygon_overlaps(
    left: DataFrame, left_rings: str, left_keep: Sequence[str],
    right: DataFrame, right_rings: str, right_keep: Sequence[str],
    cell: float, least: float = 0.0,
) -> DataFrame:
    """``left_keep, right_keep, area, share``: the common area of each pair, and its share of the left polygon.

    Pairs with an area of ``least`` or less are left out, so polygons that only
    touch give no row; where slanted boundaries touch, rounding may leave an
    area of its own size, which ``least`` removes. Repeated rows count once.
    Null and empty rings meet nothing.

    Each polygon is cut into trapezoids of a cell once, and pairs of trapezoids
    are plain rows, so no pair of polygons needs a loop over arrays in an
    expression. Only pairs of polygons that both have several cells are
    shuffled, to be summed.
    """
    a, b = _piece_cells(left, left_rings, left_keep, cell), _piece_cells(right, right_rings, right_keep, cell)
    own = a.groupBy("__id").agg(F.sum(F.expr("aggregate(items, 0D, (total, p) -> total + p.area)")).alias("own"))
    local, spread, parts = pairs_in_cells(a.join(own, "__id"), b)
    keys = ["__a_id", "__b_id", "__a_keep", "__b_keep", "__a_own"]

    def by_cell(met: DataFrame) -> DataFrame:
        return _common(met).groupBy("__z", *keys).agg(F.sum("__area").alias("area"))

    both = by_cell(spread).repartition(parts, "__a_id", "__b_id").groupBy(*keys).agg(F.sum("area").alias("area"))
    found = by_cell(local[0]).unionByName(by_cell(local[1])).select(*keys, "area").unionByName(both).where(F.col("area") > least)
    return found.select(
        *[F.col("__a_keep")[c].alias(c) for c in left_keep], *[F.col("__b_keep")[c].alias(c) for c in right_keep],
        "area", (F.col("area") / F.col("__a_own")).alias("share"),
    )


def _piece_cells(df: DataFrame, rings: str, keep: Sequence[str], size: float) -> DataFrame:
    """Cells of polygons with ``items``: the trapezoids of some area that the polygon has there."""
    keyed = _keyed(df, keep, rings)
    return cells_of(keyed, cell_index(keyed, "__id", "__rings", size), F.expr(f"filter({_pieces_sql([''], size)}, p -> p.area > 0)"), keep)


def _common(met: DataFrame) -> DataFrame:
    """A row for each two trapezoids of a pair that may meet, with ``__area``, what they share.

    Along a line of some height the stretches from l to r and from m to s share
    ``(|r - m| + |s - l| - |r - s| - |l - m|) / 2``. So over common heights the
    area follows from the mean distance of each two sides, which may cross once.
    """
    each = met.withColumn("__p", F.explode("__a_items")).withColumn("__q", F.explode("__b_items"))
    near = " AND ".join(
        f"__{p}.y0 < __{q}.y1 AND least(__{p}.l0, __{p}.l1) < greatest(__{q}.r0, __{q}.r1)" for p, q in (("p", "q"), ("q", "p"))
    )
    plain = each.where(F.expr(near)).withColumns({f"__{p}_{c}": F.expr(f"coalesce(__{p}.{c}, 0D)") for p in "pq" for c in ("y0", "y1", "l0", "l1", "r0", "r1")})
    plain = plain.withColumns({"__lo": F.expr("greatest(__p_y0, __q_y0)"), "__hi": F.expr("least(__p_y1, __q_y1)")})

    def at(p: str, side: str, y: str) -> Column:
        own = f"__{p}_{side}"
        return F.expr(f"{own}0 + ({own}1 - {own}0) * (__{y} - __{p}_y0) / (__{p}_y1 - __{p}_y0)")

    sided = plain.withColumns({f"__{p}{side}_{y}": at(p, side, y) for p in "pq" for side in "lr" for y in ("lo", "hi")})
    apart = sided.withColumns({f"__{m}{n}_{y}": F.expr(f"__p{m}_{y} - __q{n}_{y}") for m in "lr" for n in "lr" for y in ("lo", "hi")})

    def mean(k: str) -> str:
        d, e = f"__{k}_lo", f"__{k}_hi"
        return f"IF(({d} < 0) = ({e} < 0) OR {d} = 0 OR {e} = 0, (abs({d}) + abs({e})) / 2, ({d} * {d} + {e} * {e}) / (2 * (abs({d}) + abs({e}))))"

    return apart.withColumn("__area", F.expr(f"(__hi - __lo) * ({mean('rl')} + {mean('lr')} - {mean('rr')} - {mean('ll')}) / 2"))


def clipped_pieces(
    left: DataFrame, left_rings: str, left_keep: Sequence[str],
    right: DataFrame, right_rings: str, right_keep: Sequence[str],
    cell: float,
) -> DataFrame:
    """``left_keep, right_keep, ring, area``: the geometry that each pair shares, a row per trapezoid.

    Pieces do not overlap and together are the intersection; ``ring`` is closed
    and counterclockwise, with four corners, two of which may be the same.
    """
    sides = [_keyed(left, left_keep, left_rings), _keyed(right, right_keep, right_rings)]
    each = _met(*sides, cell).select("__a", "__b", F.explode("pieces").alias("p")).where("p.area > 0")
    corners = [("l0", "y0"), ("r0", "y0"), ("r1", "y1"), ("l1", "y1"), ("l0", "y0")]
    ring = F.array(*[F.struct(F.col(f"p.{x}").alias("x"), F.col(f"p.{y}").alias("y")) for x, y in corners])
    found = each.select("__a", "__b", ring.alias("ring"), F.col("p.area").alias("area"))
    for tag, side, keep in (("__a", sides[0], left_keep), ("__b", sides[1], right_keep)):
        found = found.join(side.select(F.col("__id").alias(tag), *keep).distinct(), tag)
    return found.select(*left_keep, *right_keep, "ring", "area")
