"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words. A document of the source then stands for
``target / source size`` copies; its whole copies are kept and the fraction is
rounded by pivotal dependent rounding: two documents with fractions exchange
mass until one of them is 0 or 1, so that the source's words stay the same in
each exchange. Documents of a source are dealt into groups by hash; each group
leaves one document with a fraction, and these residuals meet in a tree of
groups until one per source is left, which is rounded alone. So no task sees
more than a group, and a source's words miss its target by less than one
document.

Cases: a null text or one without words has size 0 and takes nothing. The null
source is a source of its own, last in order. Repeated rows are units of their
own. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewater.llm.common import global_rank, keyed_uniform, stage, word_count

_TIMES = "_times_taken"
EDGE = 1e-9  # a fraction this near to 0 or 1 is whole


def targets(
    sources: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[float] = (5.0, 2.0, 1.0)
) -> DataFrame:
    """``source, source_size`` -> the same with ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes. A target above ``cap`` times its source's size
    stops there; the excess goes to the others by weight, until none is above.
    Each pass is one aggregate over one row per source.
    """
    rank = global_rank(sources, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = stage(
        rank.select("source", "source_size", weight.alias("_w"), (cap * F.col("source_size")).alias("_cap")), "weights"
    )
    total, level, capped = None, None, -1
    while True:
        full = F.lit(False) if level is None else F.col("_cap") < level * F.col("_w")
        row = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("_cap"))).alias("held"),
            F.sum(F.when(~full, F.col("_w"))).alias("free"),
            F.count_if(full).alias("n"),
        ).first()
        total = share * (row["all"] or 0)
        if row["n"] == capped or not row["free"]:
            break
        capped = row["n"]
        level = (total - (row["held"] or 0.0)) / row["free"]
    level = level if level is not None else 0.0
    target = F.least(F.col("_cap"), level * F.col("_w")) if row["free"] else F.col("_cap")
    return weighed.select("source", "source_size", target.cast("double").alias("target"))


def _pivot(rows: pd.DataFrame) -> pd.DataFrame:
    """Exchange mass along one group, largest documents first; at most one row keeps a fraction."""
    rows = rows.sort_values(["size", "unit", "nth"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    p, size, draw = rows["fraction"].to_numpy(copy=True), rows["size"].to_numpy(dtype=float), rows["draw"].to_numpy()
    held = -1
    for i in range(len(p)):
        if not EDGE < p[i] < 1 - EDGE:
            continue
        if held < 0:
            held = i
            continue
        a, b, pa, pb = size[held], size[i], p[held], p[i]
        up, down = min((1 - pa) * a, pb * b), min(pa * a, (1 - pb) * b)  # words that may move to or from the held one
        moved = up if draw[i] * (up + down) < down else -down
        p[held], p[i] = pa + moved / a, pb - moved / b
        if not EDGE < p[held] < 1 - EDGE:
            held = i if EDGE < p[i] < 1 - EDGE else -1
    rows["fraction"] = [0.0 if x <= EDGE else 1.0 if x >= 1 - EDGE else x for x in p]
    return rows


UNITS = "unit long, nth long, source string, bucket long, size long, whole long, fraction double, draw double"


def copies(
    units: DataFrame, seed: int = 7, group: int = 2048, fan_in: int = 512
) -> DataFrame:
    """``unit, nth, source, n_units, size, ratio`` -> ``unit, nth, source, size, copies``.

    ``unit`` and ``nth`` tell units apart and key the random draws, so reruns
    agree. ``group`` documents meet in one task at first, ``fan_in`` residuals
    later; both only bound the memory of a task.
    """
    fraction = F.col("ratio") - F.floor("ratio")
    start = units.select(
        "unit", "nth", "source",
        F.pmod(F.xxhash64(F.lit(seed), "unit", "nth"), F.ceil(F.col("n_units") / group)).alias("bucket"),
        "size", F.floor("ratio").cast("long").alias("whole"), fraction.alias("fraction"),
        keyed_uniform(F.lit(seed), F.lit(0), "unit", "nth").alias("draw"),
    )
    alone = (F.col("size") == 0) | (F.col("fraction") <= EDGE) | (F.col("fraction") >= 1 - EDGE)
    lone_up = F.when(F.col("fraction") >= 1 - EDGE, 1).when(F.col("fraction") <= EDGE, 0).otherwise(
        (F.col("draw") < F.col("fraction")).cast("int")
    )
    start = stage(start, "units")
    done = [start.filter(alone).withColumn("fraction", lone_up.cast("double"))]
    level = start.filter(~alone)
    most = start.agg(F.max("bucket")).first()[0] or 0
    depth = 0
    while True:
        paired = stage(level.groupBy("source", "bucket").applyInPandas(_pivot, UNITS), "pivot")
        left = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        done.append(paired.filter(~left))
        depth += 1
        level = paired.filter(left).withColumn(
            "draw", keyed_uniform(F.lit(seed), F.lit(depth), F.col("unit"), F.col("nth"))
        )
        if most == 0:
            break
        most //= fan_in
        level = level.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long"))
    done.append(level.withColumn("fraction", (F.col("draw") < F.col("fraction")).cast("double")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("unit", "nth", "source", "size", (F.col("whole") + F.round("fraction").cast("long")).alias("copies"))


def mix(
    docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[float] = (5.0, 2.0, 1.0), seed: int = 7
) -> DataFrame:
    """The mix's decisions: ``doc_id, text_hash, source, size, source_size, target, copies``, one row per row of ``docs``."""
    sized = stage(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", word_count(F.col("text")).alias("size")),
        "sizes",
    )
    sources = stage(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_units")), "sources"
    )
    goal = targets(sources.select("source", "source_size"), share, cap, weights)
    plan = stage(
        goal.join(sources.select(F.col("source").alias("_s"), "n_units"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"),
        "targets",
    )
    # Equal rows are told apart by their place among them.
    keys = sized.groupBy("doc_id", "text_hash", "source", "size").agg(F.count("*").alias("_m"))
    each = keys.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m")))).drop("_m")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = plan.select(F.col("source").alias("_s"), "source_size", "target", "n_units", ratio.alias("ratio"))
    units = stage(
        each.join(F.broadcast(known) if plan.count() <= 10_000 else known, F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("unit", F.xxhash64("doc_id", "text_hash", "source")),
        "mixing",
    )
    decided = copies(units, seed).select("unit", "nth", F.col("size").alias("_size"), "source", "copies")
    same = (
        (F.col("u.unit") == F.col("d.unit")) & (F.col("u.nth") == F.col("d.nth"))
        & (F.col("u.size") == F.col("d._size")) & F.col("u.source").eqNullSafe(F.col("d.source"))
    )
    return units.alias("u").join(decided.alias("d"), same).select(
        "doc_id", "text_hash", "u.source", "u.size", "source_size", "target", "copies"
    )


def apply_mix(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns of ``docs``."""
    key = ["doc_id", "text_hash", "source"]
    taken = decisions.groupBy(*key).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_m")).filter("_copies > 0")
    joined = docs.alias("a").join(
        taken.alias("b"),
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("a.text") == F.col("b.text_hash"))
        & F.col("a.source").eqNullSafe(F.col("b.source")),
    )
    single = joined.filter("b._m = 1").select("a.*", F.sequence(F.lit(1).cast("long"), "b._copies").alias(_TIMES))
    # m equal rows share the copies: the first ones take one more where they don't divide evenly.
    nth = F.row_number().over(Window.partitionBy("a.doc_id", "b.text_hash", "a.source").orderBy(F.lit(1)))
    share = F.floor(F.col("b._copies") / F.col("b._m")) + (nth <= F.col("b._copies") % F.col("b._m")).cast("long")
    numbered = joined.filter("b._m > 1").select("a.*", share.cast("long").alias(_TIMES))
    several = numbered.filter(F.col(_TIMES) > 0).withColumn(_TIMES, F.sequence(F.lit(1).cast("long"), F.col(_TIMES)))
    return single.unionByName(several).withColumn(_TIMES, F.explode(_TIMES)).drop(_TIMES)
