"""Texts within one or two edits of each other, by the texts that remain when characters are left out.

If two texts are within k edits, leaving out at most k characters of each gives some common text. So every text posts
the digests of its own remainders, equal digests meet in a plain equi join, and the edit distance confirms. A text of
length n posts 1 + n digests for one edit and about n * n / 2 for two; nothing is compared with everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewater.operators.joins import strict_join


def _remainders(text: str, edits: int) -> Column:
    """Distinct digests of a column's text without any ``edits`` or fewer of its characters."""
    cut = "transform(sequence(1, length({t})), i -> concat(substring({t}, 1, i - 1), substring({t}, i + 1)))"
    one = f"if(length({text}) = 0, array(), {cut.format(t=text)})"
    kept = f"concat(array({text}), {one})"
    if edits == 2:
        inner = cut.format(t="t").replace("i ->", "j ->").replace("i - 1", "j - 1").replace("i + 1", "j + 1")
        kept = f"concat({kept}, flatten(transform(array_distinct({one}), t -> if(length(t) = 0, cast(array() as array<string>), {inner}))))"
    return F.expr(f"array_distinct(transform({kept}, r -> xxhash64(r)))")


def near_texts(left: DataFrame, left_text: str, right: DataFrame, right_text: str, edits: int = 1) -> DataFrame:
    """``left_text, right_text, distance`` of all pairs of different texts within ``edits`` (1 or 2) of each other.

    Each text counts once, however many rows have it; nulls pair with nothing,
    and equal texts are pairs at distance 0. Characters are code points. A
    digest that many texts share is an ordinary hot key, which AQE splits: its
    pairs are nearly all within twice ``edits``, and two texts that meet
    several times are folded by their ids before the distance is worked out.
    """
    if edits not in (1, 2):
        raise ValueError("edits is 1 or 2")
    # Neither side is small once it is spread, though its texts are: Spark takes the size of a list's rows from the list,
    # so the merge join is asked for, and the texts are spread in as many tasks as a shuffle has.
    sides = [_posted(left, left_text, "__a", edits), _posted(right, right_text, "__b", edits)]
    (a, a_texts), (b, b_texts) = sides
    met = a.hint("merge").join(b, "__key").select("__a_id", "__b_id").distinct()
    near = met.join(a_texts, "__a_id").join(b_texts, "__b_id").select("__a", "__b", F.levenshtein("__a", "__b", edits).alias("distance"))
    return near.filter("distance >= 0").select(F.col("__a").alias(left_text), F.col("__b").alias(right_text), "distance")


def _posted(df: DataFrame, text: str, name: str, edits: int) -> tuple[DataFrame, DataFrame]:
    """``__key`` and the text's id for every remainder, and the different texts with their ids.

    Should two texts have one id, each pair with either is compared with both.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.col(text).alias(name)).filter(F.col(name).isNotNull()).distinct()
    # By the id, not the text: Spark drops a partitioning that it takes for the one it has, and makes few tasks of few texts.
    texts = texts.withColumn(f"{name}_id", F.xxhash64(name)).repartition(parts, f"{name}_id")
    return texts.select(F.explode(_remainders(name, edits)).alias("__key"), f"{name}_id"), texts


def suggestions(df: DataFrame, text: str, register: DataFrame, known: str, edits: int = 1) -> DataFrame:
    """``text, suggestion, distance, rank, only``: known texts near each text of ``df`` that is not known itself.

    Nearest first, ties in text order. ``only`` marks the nearest one where no
    other known text is as near, so it can be taken without a look.
    """
    texts = df.select(F.col(text).alias("__text")).filter("__text is not null").distinct()
    names = register.select(F.col(known).alias("suggestion")).filter("suggestion is not null").distinct()
    unknown = strict_join(texts, names.withColumn("__is", F.lit(True)), [("__text", "suggestion")]).filter("__is is null")
    near = near_texts(unknown, "__text", names, "suggestion", edits)
    of_text = Window.partitionBy("__text").orderBy("distance", "suggestion")
    as_near = F.count(F.lit(1)).over(Window.partitionBy("__text", "distance"))
    ranked = near.select("*", F.row_number().over(of_text).alias("rank"), as_near.alias("__as_near"))
    return ranked.select(
        F.col("__text").alias(text), "suggestion", "distance", "rank", ((F.col("rank") == 1) & (F.col("__as_near") == 1)).alias("only")
    )
