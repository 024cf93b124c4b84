"""Connected components of a link table, by contraction in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, root``: every linked node with the least node of its component.

    Each round points every node at its least neighbour or itself, follows the
    pointers twice, and draws the links anew between the roots; links inside a
    root go. Every round at least halves the roots that still have links, and
    joins and minima split or fold hot nodes.
    """
    edges = stage(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    spark = links.sparkSession
    roots = None
    while edges.limit(1).count():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("to")), "up")
        for _ in range(2):
            further = up.select(F.col("node").alias("to"), F.col("to").alias("_far"))
            up = stage(up.join(further, "to").select("node", F.col("_far").alias("to")), "up")
        if roots is None:
            roots = up.withColumnRenamed("to", "root")
        else:
            moved = up.select(F.col("node").alias("root"), "to")
            roots = stage(
                roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
            )
        first = edges.join(up.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a").select("_a", "b")
        both = first.join(up.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b").filter("_a <> _b")
        edges = stage(both.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
    return roots if roots is not None else spark.createDataFrame([], "node long, root long")
