"""Nearest neighbours by a hash-prefix forest.

Each tree gives a vector a string of ``BITS`` hash bits, the sides of random
hyperplanes it lies on, and keeps the strings sorted. A query descends by
binary search to the longest prefix it shares with any string of a tree. Then
all trees ascend together, one bit shorter at a time, and add the stretch of
strings that share the shorter prefix, until enough candidates are collected
(repeats in several trees counted). Only candidates are scored, by their exact
inner product in double precision; no other product is computed.

For the largest inner product, not the least angle, vectors are lifted before
hashing: one more component fills them up to the largest length, and is 0 in
queries.

The index is dealt into blocks by id, each with a forest over all its rows; a
block of queries meets each block of the index, so memory is bounded by the two
block sizes, and identical vectors, however many, spread over all blocks.
``collect`` is the number of candidates as a share of the block, and at least
``k + 2`` a tree are collected, so that one tree alone gives enough different
rows; a query that still has fewer than ``k`` ascends to the root. The rule is
the same for blocks of any size. How much is needed depends on how the data
lie: for directions without any clusters, as in the test tables, hash bits tell
little, and a recall of 0.9 needs about half the rows as candidates; see the
README for measured figures.

Cases: vectors that are null, zero, of another dimension than most, or hold
null or non-finite components take no part, nor do rows without id. A row is no
candidate of a query with its id. Rows that repeat an id are candidates each;
of query rows that repeat an id the least vector counts. With ``k + 2`` rows or
fewer in a block all of them are candidates. An empty table has no results.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewater.llm.common import stage

TREES, BITS, COLLECT, ROWS, QUERIES, SEED = 48, 32, 0.9, 4096, 4096, 7


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (as double) of the rows that take part."""
    as_double = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = as_double.filter("vec_id is not null and embedding is not null").filter(~bad).filter(some)
    return good.withColumn("_size", F.size("embedding"))


def hash_bits(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Hash strings as numbers, a row per tree; ``planes``: trees, bits, components."""
    trees, bits, width = planes.shape
    side = (vectors @ planes.reshape(-1, width).T > 0).reshape(len(vectors), trees, bits)
    weight = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return (side * weight).sum(axis=2, dtype=np.uint64).T


def candidates(trees: list[tuple], codes: np.ndarray, bits: int, n: int, enough: int):
    """For each query the mask of its candidates among ``n`` rows. ``trees``: sorted strings and their rows."""
    levels = np.arange(bits, -1, -1)
    lows, highs = [], []
    for (strings, _), code in zip(trees, codes, strict=True):
        free = (np.uint64(1) << (np.uint64(bits) - levels.astype(np.uint64))) - np.uint64(1)
        first = code[:, None] & ~free[None, :]
        lows.append(np.searchsorted(strings, first))
        highs.append(np.searchsorted(strings, first | free[None, :], "right"))
    low, high = np.stack(lows), np.stack(highs)  # trees, queries, levels from the longest prefix up
    size = high - low
    found = np.cumsum(size, axis=0)
    for q in range(codes.shape[1]):
        mask = np.zeros(n, bool)
        reached = np.flatnonzero(found[-1, q] >= enough)
        top = reached[0] if len(reached) else bits
        # All trees stand one bit below the last level; they add its stretches one after another until there is enough.
        below = max(top - 1, 0)
        have = int(found[-1, q, below]) if top else 0
        grown = have + np.cumsum(size[:, q, top] - (size[:, q, below] if top else 0))
        last = int(np.searchsorted(grown, enough)) if len(reached) else len(trees)
        for t, (_, rows) in enumerate(trees):
            level = top if t <= last else below
            if t <= last or top:
                mask[rows[low[t, q, level] : high[t, q, level]]] = True
        yield mask


def _nearest(k: int, trees: int, bits: int, collect: float, longest: float, seed: int):
    def of(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("vec_id").to_numpy()
        lists = group.column("embedding").combine_chunks() if isinstance(group.column("embedding"), pa.ChunkedArray) else group.column("embedding")
        vectors = lists.flatten().to_numpy().reshape(len(ids), -1)
        asks = group.column("is_query").to_numpy(zero_copy_only=False)
        x_ids, x, q_ids, q = ids[~asks], vectors[~asks], ids[asks], vectors[asks]
        out_q, out_v, out_s = [], [], []
        if len(x) and len(q):
            planes = np.random.default_rng(seed).standard_normal((trees, bits, x.shape[1] + 1))
            lift = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
            codes = hash_bits(np.column_stack([x, lift]), planes)
            forest = []
            for code in codes:
                order = np.argsort(code, kind="stable")
                forest.append((code[order], order))
            asked = hash_bits(np.column_stack([q, np.zeros(len(q))]), planes)
            enough = max((k + 2) * trees, int(collect * len(x)))
            for i in range(0, len(q), 256):
                for j, mask in enumerate(candidates(forest, asked[:, i : i + 256], bits, len(x), enough), i):
                    at = np.flatnonzero(mask & (x_ids != q_ids[j]))
                    if len(at) < k:
                        at = np.flatnonzero(x_ids != q_ids[j])
                    score = np.einsum("ij,j->i", x[at], q[j])  # row by row, so equal rows score equally
                    best = np.lexsort((x_ids[at], -score))[:k]
                    out_q.append(np.full(len(best), q_ids[j]))
                    out_v.append(x_ids[at[best]])
                    out_s.append(score[best])
        flat = [np.concatenate(c) if c else np.zeros(0, t) for c, t in ((out_q, np.int64), (out_v, np.int64), (out_s, float))]
        return pa.table({"query_id": flat[0], "vec_id": flat[1], "score": flat[2]})

    return of


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, bits: int = BITS, collect: float = COLLECT,
    rows: int = ROWS, queries: int = QUERIES, seed: int = SEED,
) -> DataFrame:
    """``vec_id, embedding`` -> ``query_id, rank, vec_id, score``: each query's ``k`` nearest found among all rows."""
    good = stage(usable(vectors), "vectors")
    common = good.groupBy("_size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_size").limit(1).collect()
    good = good.filter(F.col("_size") == (common[0]["_size"] if common else 0)).drop("_size")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    asked = good.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n, longest, n_asked = good.agg(F.count("*"), F.coalesce(F.max(length), F.lit(0.0)), F.count_if(is_query)).first()
    x_blocks, q_blocks = max(1, -(-n // rows)), max(1, -(-n_asked // queries))

    def block(n_blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")

    def every(n_blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))

    left = good.select(block(x_blocks).alias("i"), every(q_blocks).alias("j"), "vec_id", "embedding", F.lit(False).alias("is_query"))
    right = asked.select(every(x_blocks).alias("i"), block(q_blocks).alias("j"), "vec_id", "embedding", F.lit(True).alias("is_query"))
    found = left.unionByName(right).groupBy("i", "j").applyInArrow(
        _nearest(k, trees, bits, collect, longest, seed), "query_id long, vec_id long, score double"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
