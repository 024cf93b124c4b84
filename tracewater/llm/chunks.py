"""Substring de-duplication by content-defined chunking.

A gear hash rolls over a text's bytes: each step shifts the hash and adds a
number of the new byte, so it depends on the last 32 bytes alone. A chunk ends
where its top ``bits`` bits are zero, after ``least`` bytes at the earliest and
``most`` at the latest, and never inside a character. An insertion therefore
moves the chunk ends near it only, and copies of a passage are cut alike from
the first common end on.

Chunks are told by a 128-bit digest. Of equal chunks the first stays (by
doc_id, then place) and later ones are removed, where they make up a run of
``run`` bytes or more, or the whole text; shorter runs, such as a common line,
are left.

Digests are counted first, by 64 bits and folded in each block; only chunks
whose digest is met again are moved, and a hot digest's rows are folded before
the shuffle or split by the join.

Cases: null and empty texts have no chunks; null stays null. Rows with the same
doc_id and text are one place, so they are cut alike. A null doc_id comes first
in order. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, fresh, plain_names, stage

LEAST, BITS, MOST, RUN = 32, 5, 256, 100
GEAR = (texts.mix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 50)) >> np.uint64(32)).astype(np.uint32)
OTHER = texts.mix(texts.BYTE)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: sums of 1, 2, 4, ... bytes, doubled up to 32."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def cuts(data: np.ndarray, offsets: np.ndarray, least: int, bits: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, end`` of the block's chunks."""
    ends = (np.flatnonzero(gear(data) >> np.uint32(32 - bits) == 0) + 1).tolist()
    inner = (data & 0xC0) == 0x80
    text, start, stop = [], [], []
    k = 0
    for i in range(len(offsets) - 1):
        at, last = int(offsets[i]), int(offsets[i + 1]) - 1
        while at < last:
            while k < len(ends) and ends[k] < at + least:
                k += 1
            cut = min(ends[k] if k < len(ends) else last, at + most, last)
            while cut < last and inner[cut]:
                cut += 1
            text.append(i)
            start.append(at)
            stop.append(cut)
            at = cut
    return np.array(text, np.int64), np.array(start, np.int64), np.array(stop, np.int64)


def _digests(setup: tuple):
    def of(batches):
        for _, data, offsets in texts.blocks(batches):
            _, start, stop = cuts(data, offsets, *setup)
            digest, n = np.unique(texts.stretch_hash(texts.prefix(data), start, stop), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array(n)], names=["digest", "n"])

    return of


def _chunks(setup: tuple):
    def of(batches):
        for rows, data, offsets in texts.blocks(batches):
            text, start, stop = cuts(data, offsets, *setup)
            yield texts.table(
                rows.select(["doc_id", "text_hash"]).take(pa.array(text)),
                ["doc_id", "text_hash"],
                lo=start - offsets[text],
                hi=stop - offsets[text],
                digest=texts.stretch_hash(texts.prefix(data), start, stop).view(np.int64),
                more=texts.stretch_hash(texts.prefix(data, OTHER), start, stop).view(np.int64),
            )

    return of


def later_copies(docs: DataFrame, least: int = LEAST, bits: int = BITS, most: int = MOST) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, text_hash, lo, hi, first_doc``: chunks that stand somewhere before."""
    if least < 32:
        raise ValueError("the rolling hash looks back 32 bytes")
    bound_batches(docs.sparkSession)
    setup = (least, bits, most)
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    counts = hashed.select("text").mapInArrow(_digests(setup), "digest long, n long")
    met = stage(counts.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest"), "digests")
    schema = "doc_id long, text_hash long, lo long, hi long, digest long, more long"
    shared = stage(hashed.mapInArrow(_chunks(setup), schema).join(met, "digest"), "chunks")
    place = F.struct("doc_id", "text_hash", "lo")
    firsts = stage(
        shared.groupBy("digest", "more").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "firsts"
    )
    copies = shared.join(firsts, ["digest", "more"]).filter(~place.eqNullSafe(F.col("first")))
    return copies.select("doc_id", "text_hash", "lo", "hi", F.col("first.doc_id").alias("first_doc"))


def _removed(columns: list[str], name: str, run: int):
    def of(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts_, removed, spans_, sources = [], [], [], []
                for text, copies in zip(part.column("text"), part.column(name), strict=True):
                    raw = (text.as_py() or "").encode()
                    runs: list[list] = []
                    for c in sorted(copies.as_py() or [], key=lambda c: c["lo"]):
                        if runs and runs[-1][1] == c["lo"]:
                            runs[-1][1] = c["hi"]
                            runs[-1][2].add(c["first_doc"])
                        else:
                            runs.append([c["lo"], c["hi"], {c["first_doc"]}])
                    runs = [r for r in runs if r[1] - r[0] >= run or r[1] - r[0] == len(raw)]
                    edges = [0, *[x for r in runs for x in r[:2]], len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    texts_.append(kept.decode() if text.is_valid else None)
                    removed.append(sum(r[1] - r[0] for r in runs))
                    spans_.append(len(runs))
                    sources.append(sorted({d for r in runs for d in r[2] if d is not None}))
                arrays = [pa.array(texts_, pa.string()) if c == "text" else part.column(c) for c in columns]
                more = [pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()), pa.array(sources, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays + more, names=[*columns, *ADDED])

    return of


ADDED = ["n_removed", "n_spans", "copied_from"]


def without_copies(docs: DataFrame, copies: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` with later copies cut out of ``text``, and ``n_removed`` (bytes), ``n_spans``, ``copied_from`` (doc_ids)."""
    plain, named = plain_names(docs.drop(*ADDED))
    name = fresh(plain, "copies")
    lists = copies.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi", "first_doc")).alias(name))
    own = lists.select(F.col("doc_id").alias("b_doc"), F.col("text_hash").alias("b_text"), name).alias("b")
    hashed = F.xxhash64(F.coalesce(F.col("a.text"), F.lit("")))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.b_doc")) & (hashed == F.col("b.b_text"))
    joined = plain.alias("a").join(own, same, "left").select("a.*", f"b.{name}")
    added = [T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("copied_from", T.ArrayType(T.LongType()))]
    return named(joined.mapInArrow(_removed(plain.columns, name, run), T.StructType([*plain.schema.fields, *added])))
