"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's set holds its distinct word shingles; its signature has
``COORDINATES`` min-hashes of the set. Documents with equal sets are one class,
told by its least doc_id. Classes are posted under the coordinate-value pairs
of the signature. A candidate has at least ``MATCHES`` equal coordinates, more
than there are groups of ``COORDINATES / (MATCHES - 1)`` coordinates, so two of
them fall into one group: lists are merged two at a time inside the groups, and
all other merges are skipped. The remaining coordinates are only looked up, to
count the collisions of the pairs that met. With 24 coordinates and 9 matches,
a pair of similarity 0.8 is missed with a probability of about 8e-7.

Merged lists are not multiplied out. First every member of a list meets the
list's centre only (the member whose lists are the longest); collisions are
counted over whole signatures, pairs below the threshold go, and the others are
confirmed on their full sets. Where the lists around one component then still
hold members outside it, these are compared with all members: collisions first,
in blocks of ``WIDE`` by ``WIDE`` signatures, then the full sets of those that
meet. Two members of the component need no comparison, since a link between
them changes nothing. So no pair that could join two components is left out,
and no task holds more than two blocks.

Cases: null or empty texts and texts without words have the empty set and link
with nothing; with fewer words than a shingle the whole sequence is the one
shingle. Rows with the same doc_id are the same document. A row without doc_id
links with nothing, has no component and is kept. Very long texts are blocks of
their own in a task. An empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, stage
from tracewater.llm.components import components

COORDINATES, MATCHES, BLOCK, WIDE = 24, 9, 512, 2048


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes (A-Z lower-cased)."""
    lowered = texts.LOWER[data]
    starts, ends = texts.words(lowered)
    hashed = texts.stretch_hash(texts.prefix(lowered), starts, ends)
    edge = np.searchsorted(starts, offsets)
    rolled = hashed.copy()
    for j in range(1, width):
        rolled[: len(hashed) - j] = texts.mix(rolled[: len(hashed) - j]) + hashed[j:]
    out = []
    for lo, hi in zip(edge[:-1], edge[1:], strict=True):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo : hi - width + 1]))
        elif hi > lo:
            placed = texts.mix(hashed[lo:hi] + np.arange(hi - lo, dtype=np.uint64))
            out.append(texts.mix(placed.sum(keepdims=True) ^ np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Min-hashes, a row per set; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), coordinates), np.uint64)
    if not len(sets):
        return out
    flat = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keys = texts.mix(np.arange(2 * coordinates, dtype=np.uint64) + np.uint64(1 << 40))
    for j in range(coordinates):
        out[:, j] = np.minimum.reduceat((flat ^ keys[2 * j]) * (keys[2 * j + 1] | np.uint64(1)), begins)
    return out


def _signed(width: int, coordinates: int):
    def of(batches):
        for rows, data, offsets in texts.blocks(batches):
            sets = shingle_sets(data, offsets, width)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            sigs = signatures([sets[i] for i in full], coordinates).view(np.int64)
            digest = np.zeros((2, len(sets)), np.int64)
            for i in full:  # order-free sums of two mixes, and the size, tell sets apart
                digest[0, i] = texts.mix(sets[i]).sum().view(np.int64)
                digest[1, i] = texts.mix(sets[i] ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)
            place = np.full(len(sets), -1)
            place[full] = np.arange(len(full))
            yield texts.table(
                rows, ["doc_id"], n_shingles=sizes, digest_a=digest[0], digest_b=digest[1],
                signature=pa.array([sigs[p] if p >= 0 else None for p in place], pa.list_(pa.int64())),
            )

    return of


def common(left: list[np.ndarray], right: list[np.ndarray], at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of ``left[i]`` and ``right[j]`` for the pairs ``at``."""
    out = np.empty(len(at[0]), np.int64)
    if len(at[0]) * 50 < len(left) * len(right) or len(at[0]) < 8:
        for k, (i, j) in enumerate(zip(*at, strict=True)):
            a, b = (left[i], right[j]) if len(left[i]) <= len(right[j]) else (right[j], left[i])
            found = np.searchsorted(b, a)
            out[k] = np.count_nonzero(b[np.minimum(found, len(b) - 1)] == a)
        return out
    # Many pairs: count by products of 0/1 matrices over the shared shingles, some columns at a time.
    both, which = np.unique(np.concatenate(left + right), return_inverse=True)
    n_left = sum(map(len, left))
    seen = np.bincount(which[:n_left], minlength=len(both)) > 0
    seen &= np.bincount(which[n_left:], minlength=len(both)) > 0
    column = np.cumsum(seen) - 1
    total = np.zeros((len(left), len(right)), np.float32)
    row_l = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_r = np.repeat(np.arange(len(right)), [len(s) for s in right])
    c_l, c_r = which[:n_left], which[n_left:]
    for lo in range(0, int(seen.sum()), 4096):
        part = []
        for rows, cols, n in ((row_l, c_l, len(left)), (row_r, c_r, len(right))):
            use = seen[cols] & (column[cols] >= lo) & (column[cols] < lo + 4096)
            m = np.zeros((n, 4096), np.float32)
            m[rows[use], column[cols[use]] - lo] = 1
            part.append(m)
        total += part[0] @ part[1].T
    return total[at].astype(np.int64)


def _links(width: int, coordinates: int, matches: int, percent: int):
    """Task function on one group: left rows against right rows; links between the components that they join."""

    def of(group: pa.Table) -> pa.Table:
        sets, comps, left = [], [], []
        for rows, data, offsets in texts.blocks(group.to_batches()):
            sets += shingle_sets(data, offsets, width)
            comps += rows.column("component").to_pylist()
            left += rows.column("is_left").to_pylist()
        l_at = [i for i, x in enumerate(left) if x and len(sets[i])]
        r_at = [i for i, x in enumerate(left) if not x and len(sets[i])]
        found = []
        if l_at and r_at:
            sig = signatures([sets[i] for i in l_at + r_at], coordinates)
            s_l, s_r = sig[: len(l_at)], sig[len(l_at) :]
            count = np.zeros((len(l_at), len(r_at)), np.int8)
            for j in range(coordinates):
                count += s_l[:, j, None] == s_r[None, :, j]
            c_l, c_r = np.array([comps[i] for i in l_at]), np.array([comps[i] for i in r_at])
            at = np.nonzero((count >= matches) & (c_l[:, None] != c_r[None, :]))
            if len(at[0]):
                n_l, n_r = np.array([len(sets[i]) for i in l_at]), np.array([len(sets[i]) for i in r_at])
                both = common([sets[i] for i in l_at], [sets[i] for i in r_at], at)
                near = 100 * both >= percent * (n_l[at[0]] + n_r[at[1]] - both)
                parent: dict = {}

                def root(x):
                    while parent.get(x, x) != x:
                        parent[x] = parent.get(parent[x], parent[x])
                        x = parent[x]
                    return x

                for i, j in zip(at[0][near], at[1][near], strict=True):
                    a, b = root(comps[l_at[i]]), root(comps[r_at[j]])
                    if a != b:
                        parent[a] = b
                        found.append((comps[l_at[i]], comps[r_at[j]]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return of


def _candidates(keys: list[str], matches: int):
    """Task function on one block of signatures: the rows that meet one of another component."""

    def of(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sig = np.stack([x.values.to_numpy() for x in group.column("signature")])
        left = group.column("is_left").to_numpy()
        comps = group.column("component").to_numpy()
        l_at, r_at = np.flatnonzero(left), np.flatnonzero(~left)
        count = np.zeros((len(l_at), len(r_at)), np.int8)
        for j in range(sig.shape[1]):
            count += sig[l_at, j][:, None] == sig[r_at, j][None, :]
        meet = (count >= matches) & (comps[l_at][:, None] != comps[r_at][None, :])
        rows = np.concatenate([l_at[meet.any(axis=1)], r_at[meet.any(axis=0)]])
        return group.select([*keys, "doc_id", "component", "is_left"]).take(pa.array(rows))

    return of


def merged_lists(heads: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """``doc_id, at, value``: a row for each two coordinates of a group; at least ``matches`` equal ones share one."""
    groups = [list(range(g, coordinates, matches - 1)) for g in range(matches - 1)]
    pairs = [(i, j) for g in groups for n, i in enumerate(g) for j in g[n + 1 :]]
    both = F.array(*[F.xxhash64(F.get("signature", F.lit(i)), F.get("signature", F.lit(j))) for i, j in pairs])
    return heads.select("doc_id", F.posexplode(both).alias("at", "value"))


def _confirm(docs: DataFrame, blocks: DataFrame, width: int, coordinates: int, matches: int, percent: int) -> DataFrame:
    """Links among the components of each block: ``key`` columns, ``doc_id, component, is_left``."""
    keys = [c for c in blocks.columns if c not in ("doc_id", "component", "is_left")]
    rows = blocks.hint("merge").join(docs.select("doc_id", "text"), "doc_id")  # one plan at every size
    return rows.groupBy(*keys).applyInArrow(_links(width, coordinates, matches, percent), "a long, b long")


def _texts_of(docs: DataFrame, with_set: DataFrame, members: DataFrame) -> DataFrame:
    """``doc_id, text`` of the members, each different text of a doc_id once; repeated rows are folded in their tasks."""
    twice = stage(with_set.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "twice")
    if not twice.limit(1).count():
        return docs.join(members, "doc_id").select("doc_id", "text")
    single = docs.join(members.join(twice, "doc_id", "left_anti").hint("merge"), "doc_id").select("doc_id", "text")
    again = docs.join(members.join(twice, "doc_id", "left_semi"), "doc_id").groupBy("doc_id", F.xxhash64("text").alias("k"))
    return single.unionByName(again.agg(F.first("text").alias("text")).select("doc_id", "text"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES, block: int = BLOCK, wide: int = WIDE
) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_shingles, component_id, kept``, one row per row."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, n_shingles long, digest_a long, digest_b long, signature array<long>"
    signed = stage(docs.mapInArrow(_signed(width, coordinates), schema), "signatures")
    digest = ["digest_a", "digest_b", "n_shingles"]
    with_set = signed.filter("n_shingles > 0 and doc_id is not null")
    # Equal sets have equal signatures: one row for each set, however many documents and rows have it.
    classes = stage(with_set.groupBy(*digest).agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")), "classes")
    heads = classes.select("doc_id", "signature")

    posts = merged_lists(heads, coordinates, matches)
    lists = stage(posts.groupBy("at", "value").agg(F.count("*").alias("n")).filter("n > 1"), "lists")
    posts = stage(posts.join(lists, ["at", "value"]), "posts")
    weight = posts.groupBy("doc_id").agg(F.sum("n").alias("_weight"))
    weighed = stage(posts.join(weight, "doc_id").select("at", "value", "doc_id", "_weight"), "weighed")
    # Texts of all members, fetched once; sort-merge at every size, since the members grow with the documents.
    members_only = weighed.select("doc_id").distinct().hint("merge")
    listed = stage(_texts_of(docs, with_set, members_only), "listed")
    centres = stage(
        weighed.groupBy("at", "value").agg(F.max(F.struct("_weight", -F.col("doc_id"))).alias("_top"))
        .select("at", "value", (-F.col("_top.col2")).alias("centre")), "centres",
    )
    spokes = stage(
        weighed.join(centres, ["at", "value"]).filter("doc_id <> centre").select("doc_id", "centre").distinct(), "spokes"
    )
    equal = F.aggregate(F.zip_with("signature", "_other", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    other = heads.select(F.col("doc_id").alias("centre"), F.col("signature").alias("_other"))
    counted = spokes.join(heads, "doc_id").join(other, "centre").filter(equal >= matches).select("doc_id", "centre").distinct()
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_n") / block)).alias("part")
    counted = stage(counted, "counted")
    members = counted.join(counted.groupBy("centre").agg(F.count("*").alias("_n")), "centre").select("centre", part, "doc_id")
    members = stage(members, "members")
    star = members.select("centre", "part", "doc_id", F.col("doc_id").alias("component"), F.lit(False).alias("is_left")).unionByName(
        members.select("centre", "part").distinct().select("centre", "part", F.col("centre").alias("doc_id"), F.col("centre").alias("component"), F.lit(True).alias("is_left"))
    )
    setup = (width, coordinates, matches, percent)
    links = stage(_confirm(listed, star, *setup), "near")

    roots = components(links)
    labelled = heads.select("doc_id").distinct().join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("component")
    )
    # Members by the component of their lists' centre: who is outside it, and who is there at all.
    around = weighed.join(centres, ["at", "value"]).select("doc_id", "centre").distinct()
    main = labelled.select(F.col("doc_id").alias("centre"), F.col("component").alias("main"))
    known = stage(around.join(main, "centre").select("doc_id", "main").distinct().join(labelled, "doc_id"), "around")
    outside = known.filter("component <> main")
    sizes = stage(
        known.groupBy("main").agg(F.count("*").alias("_n"), F.count_if(F.col("component") != F.col("main")).alias("_out")).filter("_out > 0"),
        "spread",
    )
    rights = F.ceil(F.col("_n") / wide).cast("int")
    lefts = F.ceil(F.col("_out") / wide).cast("int")
    own_right, own_left = F.pmod(F.xxhash64("doc_id"), rights).cast("int"), F.pmod(F.xxhash64("doc_id"), lefts).cast("int")
    l_rows = outside.join(sizes, "main").select(
        "main", own_left.alias("i"), F.explode(F.sequence(F.lit(0), rights - 1)).alias("j"), "doc_id", "component", F.lit(True).alias("is_left")
    )
    r_rows = known.join(sizes, "main").select(
        "main", F.explode(F.sequence(F.lit(0), lefts - 1)).alias("i"), own_right.alias("j"), "doc_id", "component", F.lit(False).alias("is_left")
    )
    meeting = stage(
        l_rows.unionByName(r_rows).join(heads, "doc_id").groupBy("main", "i", "j").applyInArrow(
            _candidates(["main", "i", "j"], matches), "main long, i int, j int, doc_id long, component long, is_left boolean"
        ),
        "meeting",
    )
    more = stage(_confirm(listed, meeting, *setup), "near")
    if more.limit(1).count():
        # Only components that are left are linked anew; their ids are their least members, so a root stays the least.
        further = components(more).select(F.col("node").alias("component"), F.col("root").alias("_far"))
        roots = labelled.join(further, "component", "left").select(
            F.col("doc_id").alias("node"), F.coalesce("_far", "component").alias("root")
        )
    named = stage(
        classes.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(*digest, F.coalesce("root", "doc_id").alias("component_id")),
        "named",
    )
    with_id = signed.select("doc_id", *digest)
    out = with_id.join(named, digest, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
