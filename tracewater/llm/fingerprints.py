"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is lower-cased (A-Z) and cut into words. A k-mer is ``k`` words in a
row; the hashes of its inner s-mers (``s`` words in a row) are compared, and
the k-mer is an anchor when the smallest stands first or last (a closed
syncmer). Whether a k-mer is an anchor depends on the k-mer alone, so equal
passages have the same anchors wherever they stand, and a text's anchors have
positions that passages can be matched by. The fingerprint is all anchors with
their positions; ``overlap`` is the Jaccard similarity of two texts' whole sets
of anchor hashes. ``sketch`` keeps the ``m`` smallest distinct hashes only, and
``likeness`` estimates the overlap from two sketches.

Cases: a text with 1 to k-1 words has one anchor, the whole sequence. A null or
empty text or one without words has the empty fingerprint; two empty
fingerprints are alike (1), an empty and another one are not (0). Equal texts
have equal fingerprints. Repeated rows and clashing extra columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the body does with it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BLANK)
    return F.filter(parts, lambda w: w != "")


def _shifted(array: Column, by: int, keep: Column) -> Column:
    return F.slice(array, F.lit(1 + by), keep)


def anchors(text: Column, k: int = 6, s: int = 3) -> Column:
    """``array<struct<at, hash>>``: the closed syncmers by their first word (from 0)."""
    inner = k - s + 1  # s-mers in a k-mer

    def of_hashes(h: Column) -> Column:
        n = F.size(h)
        smers = F.transform(
            F.arrays_zip(*[_shifted(h, j, n - (s - 1)).alias(f"w{j}") for j in range(s)]),
            lambda z: F.xxhash64(*[z[f"w{j}"] for j in range(s)]),
        )
        return let(smers, lambda g: of_smers(h, g))

    def of_smers(h: Column, g: Column) -> Column:
        n = F.size(g) - (inner - 1)
        # A k-mer's hash: its s-mers at both ends and in between, which hold all its words.
        cover = sorted({*range(0, inner, s), inner - 1})
        zipped = F.arrays_zip(*[_shifted(g, j, n).alias(f"m{j}") for j in range(inner)])

        def closed(z: Column) -> Column:
            middle = F.least(*[z[f"m{j}"] for j in range(1, inner - 1)]) if inner > 3 else z["m1"]
            return F.least(z["m0"], z[f"m{inner - 1}"]) <= middle

        marked = F.transform(
            zipped, lambda z, i: F.when(closed(z), F.struct(i.alias("at"), F.xxhash64(*[z[f"m{j}"] for j in cover]).alias("hash")))
        )
        return F.filter(marked, lambda a: a.isNotNull())

    def of_words(w: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(w).alias("hash")))
        none = F.slice(whole, 1, 0)
        many = let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes)
        return F.when(F.size(w) >= k, many).when(F.size(w) > 0, whole).otherwise(none)

    return let(words(text), of_words)


def sketch(anchor_array: Column, m: int = 64) -> Column:
    """The ``m`` smallest distinct anchor hashes."""
    return F.slice(F.array_sort(F.array_distinct(F.transform(anchor_array, lambda a: a["hash"]))), 1, m)


def as_text(anchor_array: Column) -> Column:
    """All anchors in their order, each as 16 hex digits of its hash and 8 of its position."""

    def digits(number: Column, n: int) -> Column:
        return F.lpad(F.lower(F.hex(number)), n, "0")

    return F.array_join(F.transform(anchor_array, lambda a: F.concat(digits(a["hash"], 16), digits(a["at"], 8))), "")


def hashes(anchor_array: Column) -> Column:
    """The distinct anchor hashes."""
    return F.array_distinct(F.transform(anchor_array, lambda a: a["hash"]))


def overlap(a: Column, b: Column) -> Column:
    """Share of common hashes among all distinct hashes of both."""

    def of_common(common: Column) -> Column:
        union = F.size(a) + F.size(b) - common
        return F.when(union == 0, 1.0).otherwise(common / union)

    return let(F.size(F.array_intersect(a, b)), of_common).cast("double")


def likeness(a: Column, b: Column, m: int = 64) -> Column:
    """Share of common hashes among the ``m`` smallest of both sketches."""

    def of_union(u: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, 1.0).otherwise(common / F.size(u))

    return let(F.slice(F.array_sort(F.array_union(a, b)), 1, m), of_union).cast("double")


def with_next(docs: DataFrame, key: str, columns: list[str], stretches: int) -> DataFrame:
    """``docs`` and, as struct ``following``, ``columns`` of the next row in descending ``key``; the first follows the last.

    The order is cut into stretches at approximate quantiles of ``key``; a
    stretch's own window gives the next row, and its last row finds the first
    row of the next stretch, which is dealt to both. Equal keys go by
    ``columns``; null keys come last.
    """
    low = docs.agg(F.min(key), F.max(key), F.count("*"), F.percentile_approx(key, [i / stretches for i in range(1, stretches)])).first() if stretches > 1 else None
    cuts = sorted(set(low[3] or []), reverse=True) if low else []
    edges = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # Stretch 0 holds the greatest keys; null keys have one more stretch at the end.
    dealt = docs.withColumn(
        "_stretch", F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(F.size(F.filter(edges, lambda c: c >= F.col(key))))
    )
    heads = dealt.groupBy("_stretch").agg(F.max(key).alias("_head"), F.count("*").alias("_n"))
    # One row per stretch: the stretch before it in the order, which needs its first row.
    order = Window.orderBy("_stretch")
    before = heads.select(
        F.col("_stretch").alias("_s"),
        F.col("_head"),
        F.coalesce(F.lag("_stretch").over(order), F.max("_stretch").over(Window.partitionBy())).alias("_before"),
    )
    rows = dealt.join(F.broadcast(before), F.col("_stretch") == F.col("_s")).drop("_s")
    first = F.col(key).eqNullSafe(F.col("_head"))
    twice = rows.withColumn(
        "_to",
        F.explode(
            F.when(
                first,
                F.array(F.struct(F.col("_stretch").alias("s"), F.lit(True).alias("own")), F.struct(F.col("_before").alias("s"), F.lit(False).alias("own"))),
            ).otherwise(F.array(F.struct(F.col("_stretch").alias("s"), F.lit(True).alias("own"))))
        ),
    ).select(*docs.columns, F.col("_to.s").alias("_stretch"), F.col("_to.own").alias("_own"))
    window = Window.partitionBy("_stretch").orderBy(
        F.col("_own").desc(), F.col(key).desc_nulls_last(), *[F.col(c) for c in columns]
    )
    following = F.lead(F.struct(*columns)).over(window)
    return twice.withColumn("following", following).filter("_own").drop("_own", "_stretch")
