"""Quality classifier: supervised subword embeddings.

A text's features are its words and its character n-grams (3 and 4 bytes inside
a word, with one blank as word edge), hashed into buckets, plus one feature
that every text has. A text is the average of its features' learned vectors; a
softmax layer gives the classes. Vectors and layer are trained together by
stochastic gradient descent in numpy.

The fit takes a sample of at most ``sample`` labelled documents, those with the
least keyed hash of their id; rows that repeat a doc_id and its text count once,
and different texts of a doc_id one each. The driver gets and holds the sample's
features packed. Since the layer is linear, a bucket's vector
gives one number when scoring, so the model that travels to the tasks has
``2**bits`` numbers, and scoring is one pass over the texts without a shuffle.

Cases: a null or empty text has the common feature alone and gets its score.
Labels that are null or not 0 or 1 do not take part; a document with
contradicting labels counts as each of them. Without any usable label, or with
one class only, all scores are the share of label 1 (0.5 without labels).
Repeated rows are scored each. A very long text is a block of its own in a
task. An empty table has no scores and gives 0.5 to others. Labels are joined by
id alone; extra columns are kept, whatever their names, and not read.
"""

from __future__ import annotations

import itertools
import pickle
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, plain_names

BITS, WIDTH, EPOCHS, RATE, SAMPLE, SEED = 18, 16, 12, 0.6, 4000, 7


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def features(data: np.ndarray, offsets: np.ndarray, bits: int):
    """``(bucket, position)`` arrays of one kind of feature after another."""
    drop = np.uint32(32 - bits)
    wide = data.astype(np.uint32)
    blank = texts.BLANK[data]
    three = wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16))
    inside = ~blank[1:-1]
    at = np.flatnonzero(inside)
    yield (three[at] * np.uint32(0x9E3779B1)) >> drop, at + 1
    at = np.flatnonzero(inside[:-1] & inside[1:])
    four = three[at] | (wide[at + 3] << np.uint32(24))
    yield ((four ^ (four >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> drop, at + 1
    starts, ends = texts.words(data)
    hashed = texts.stretch_hash(texts.prefix(data), starts, ends)
    yield (hashed >> np.uint64(64 - bits)).astype(np.uint32), starts
    again = np.zeros(len(starts), np.uint32)
    again[1:] = hashed[1:] == hashed[:-1]
    again[np.searchsorted(starts, offsets[:-1])[np.diff(np.searchsorted(starts, offsets)) > 0]] = 0
    yield again + np.uint32(1), starts


def _packed(buckets: np.ndarray, n: np.ndarray) -> bytes:
    steps = np.diff(buckets.astype(np.int64), prepend=0)
    return zlib.compress(pickle.dumps([a.astype(np.min_scalar_type(a.max())) for a in (steps, n)]), 1)


class Sample:
    """Rows ``(label, buckets, shares)`` of a sample, held packed; a row is unpacked each time it is asked for."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        label, body = self.rows[k]
        steps, n = (a.astype(np.int64) for a in pickle.loads(zlib.decompress(body)))
        return label, np.cumsum(steps).astype(np.int32), (n / n.sum()).astype(np.float32)

    def ordered(self) -> Sample:
        """Rows by label, number of buckets and buckets: reruns train alike, however rows arrive."""
        sizes = [(label, len(ids)) for label, ids, _ in self]
        by_size = sorted(range(len(self)), key=sizes.__getitem__)
        out = []
        for _, same in itertools.groupby(by_size, key=sizes.__getitem__):
            out += sorted(same, key=lambda k: self[k][1].tobytes())
        return Sample([self.rows[k] for k in out])


def _sparse(bits: int):
    """Task function: a text's distinct buckets and how often each occurs, packed."""

    def of(batches):
        for rows, data, offsets in texts.blocks(batches):
            kinds = list(features(data, offsets, bits))
            bodies = []
            for i in range(rows.num_rows):
                found = [b[np.searchsorted(at, offsets[i]) : np.searchsorted(at, offsets[i + 1])] for b, at in kinds]
                found.append(np.zeros(1, np.uint32))
                bucket, n = np.unique(np.concatenate(found), return_counts=True)
                bodies.append(_packed(bucket, n))
            yield texts.table(rows, ["quality"], body=pa.array(bodies, pa.binary()))

    return of


def train(rows: Sequence[tuple], bits: int = BITS, width: int = WIDTH, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """``(label, buckets, shares)`` -> a number for each bucket; a text's log-odds are their average."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer = np.zeros((2, width), np.float32)
    rounds, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, ids, shares = rows[k]
            step = rate * (1 - rounds / total)
            rounds += 1
            hidden = shares @ vectors[ids]
            logits = layer @ hidden
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= step * np.outer(p, hidden)
            # Plain averages would move each vector by its share only; the step is per feature, as in the sum.
            vectors[ids] -= (step * np.minimum(shares * len(ids), 1.0))[:, None] * back
    return (vectors @ (layer[1] - layer[0])).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Weights by bucket from at most ``sample`` labelled documents of ``docs``."""
    bound_batches(docs.sparkSession)
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()
    chosen = (
        docs.select("doc_id").join(usable, "doc_id").distinct()
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "quality").limit(sample)
    )
    found = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality", F.xxhash64("text").alias("k")).agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "quality", "k").limit(sample)
        .select("quality", "text").mapInArrow(_sparse(bits), "quality int, body binary")
    )
    got = found.toArrow()
    order = Sample(list(zip(map(int, got.column(0).to_pylist()), got.column(1).to_pylist(), strict=True))).ordered()
    del got
    ones = sum(label for label, _ in order.rows)
    if ones in (0, len(order)):
        share = ones / len(order) if order else 0.5
        return np.full(1 << bits, {0.0: -50.0, 1.0: 50.0}.get(share, 0.0), np.float32)
    return train(order, bits, seed=seed)


def _scored(weights, bits: int, keep: list[str], name: str):
    def of(batches):
        numbers = weights.value
        for rows, data, offsets in texts.blocks(batches):
            total, n = np.full(rows.num_rows, float(numbers[0])), np.ones(rows.num_rows)
            for bucket, at in features(data, offsets, bits):
                total += texts.per_text(numbers[bucket], at, offsets)
                n += np.diff(np.searchsorted(at, offsets))
            yield texts.table(rows, keep, **{name: 1 / (1 + np.exp(-np.clip(total / n, -50, 50)))})

    return of


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` (a new one in place of theirs): how likely label 1 is (0 to 1)."""
    docs, named = plain_names(docs.drop(name))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return named(docs.mapInArrow(_scored(shared, bits, docs.columns, name), schema))
