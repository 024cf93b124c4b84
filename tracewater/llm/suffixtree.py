"""Scoring texts with a probabilistic suffix tree over words.

A text is its words, lower-cased (A-Z), and an end symbol. The tree's contexts
are the words before a symbol: every suffix of the history of 1 to ``DEPTH``
words. A context is retained by a divergence test against the next shorter
one: the log-likelihood its next-symbol distribution gains, each training
occurrence being judged by the others (so that a context whose continuations
never repeat gains nothing), must exceed ``GAIN`` nats. A symbol is scored in
the state of the longest retained suffix of its history.

The root deals ``(n + 0.5) / norm`` to each word by its training count, and
``0.5 / norm`` to a word that is not known. A retained context deals ``(c +
WEIGHT * shorter) / (n + WEIGHT)``, where ``shorter`` is what the next shorter
retained suffix, or the root, deals to the symbol.

What is learned grows with the corpus and is never sent around whole. Texts are
packed into blocks of some ``bucket / 4`` words. A block folds its n-grams to
distinct keys with their number in training texts, and a sum over all blocks
comes back for each key, so a context, however common, is one entry a block. A
context's own count is that of its words as an n-gram, since each word has a
symbol behind it. N-grams of three words or more are counted only where their
context occurs twice in training; a context that occurs once gains nothing, so
no context is lost by that. The gains, in units of ``2**-20``
nats, are summed by context in the same way. N-grams are told by 64-bit hashes.

Little is written: blocks and sums are kept in tables bucketed by the block's
number, so they cross one shuffle when they are made and none to be read. Keys cross one shuffle only: with
the sum, a key found twice or more gets its place among its bucket's keys, by
which its gains are told. Shuffle files go as soon as their job has ended.

Cases: a null or empty text is the end symbol alone. A row without doc_id is
not held out by a condition on it. Without training texts every symbol has
probability 1 in both scores. Repeated rows are scored each; extra columns are
not read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, stage
from tracewater.session import shared_folder

DEPTH, GAIN, WEIGHT, BUCKET = 4, 3.0, 3.0, 2_000_000
END = np.uint64(0)  # the end symbol's key; no word hashes to it in practice
UNIT = float(1 << 20)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a block's words, each text followed by the end symbol, and where each text begins."""
    lowered = texts.LOWER[data]
    starts, ends = texts.words(lowered)
    words = texts.stretch_hash(texts.prefix(lowered), starts, ends)
    edge = np.searchsorted(starts, offsets)
    keys = np.insert(words, edge[1:], END)
    return keys, edge + np.arange(len(edge))


def _lean(values: np.ndarray) -> np.ndarray:
    return values.astype(np.result_type(np.min_scalar_type(values.min(initial=0)), np.min_scalar_type(values.max(initial=0))))


def _planes(values: np.ndarray) -> bytes:
    """64-bit values as their bytes, first all lowest ones, without the leading bytes that are 0 in all."""
    planes = values.view(np.uint8).reshape(-1, 8)
    used = -(-int(values.max(initial=0)).bit_length() // 8)
    return np.ascontiguousarray(planes[:, :used].T).tobytes()


def _from_planes(n: int, raw: bytes) -> np.ndarray:
    planes = np.zeros((n, 8), np.uint8)
    used = len(raw) // n if n else 0
    planes[:, :used] = np.frombuffer(raw, np.uint8).reshape(used, n).T
    return planes.view(np.uint64).ravel()


def _packed(sorted_keys: np.ndarray) -> tuple:
    """Sorted keys as the bytes of their steps."""
    steps = np.diff(sorted_keys, prepend=np.uint64(0))
    first = int(sorted_keys[0]) if len(steps) else 0
    steps[:1] = 0
    return first, len(steps), _planes(steps)


def _unpacked(first: int, n: int, raw: bytes) -> np.ndarray:
    steps = _from_planes(n, raw)
    steps[:1] = first
    return np.cumsum(steps, dtype=np.uint64)


def _signed(values: np.ndarray) -> tuple:
    """Numbers of both signs as planes of bytes, the sign being the lowest bit."""
    return len(values), _planes(((values << 1) ^ (values >> 63)).view(np.uint64))


def _unsigned(n: int, raw: bytes) -> np.ndarray:
    value = _from_planes(n, raw)
    return (value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).view(np.int64)


def _shut(content) -> bytes:
    raw = pickle.dumps(content)
    return pickle.dumps((len(raw), pa.compress(raw, codec="zstd", asbytes=True)))


def _opened(body: bytes):
    size, packed = pickle.loads(body)
    return pickle.loads(pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True))


BLOCK = "blob long, kind int, bucket int, body binary"
BODY = "blob long, body binary, n long, n_train long"


def _blocks(size: int):
    """Task function: texts -> blocks of words, one row each, with their number of words and of training words."""

    def of(batches):
        held: list[tuple] = []
        made = have = 0

        def packed():
            nonlocal held, have, made
            flags, lengths, keys = (np.concatenate([h[i] for h in held]) for i in range(3))
            vocabulary, at, number = np.unique(keys, return_inverse=True, return_counts=True)
            order = np.argsort(-number, kind="stable")
            rank = np.empty(len(order), np.uint64)  # common words have small numbers
            rank[order] = np.arange(len(order))
            ids = pa.concat_arrays([h[3] for h in held])
            body = _shut((ids, np.packbits(flags), _lean(lengths), _packed(vocabulary), _lean(number), _planes(rank[at])))
            blob = (TaskContext.get().partitionId() << 32) + made
            made, held, have = made + 1, [], 0
            row = [[blob], [body], [len(keys)], [int(lengths[~flags].sum())]]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["blob", "body", "n", "n_train"]
            )

        for rows, data, offsets in texts.blocks(batches):
            keys, begin = tokens(data, offsets)
            held.append((rows.column("held_out").to_numpy(zero_copy_only=False), np.diff(begin), keys, rows.column("doc_id")))
            have += len(keys)
            if have >= size:
                yield packed()
        if held:
            yield packed()

    return of


def _words_of(body: bytes) -> tuple:
    """A block's ids, held-out flags, lengths, words by falling frequency, and the place there of each of its words."""
    ids, flags, lengths, vocabulary, number, ranks = _opened(body)
    lengths = lengths.astype(np.int64)
    vocabulary = _unpacked(*vocabulary)[np.argsort(-number.astype(np.int64), kind="stable")]
    return ids, np.unpackbits(flags, count=len(lengths)).astype(bool), lengths, vocabulary, _from_planes(int(lengths.sum()), ranks).astype(np.int64)


class Words:
    """A block's words, their n-grams, and the sums that have come back for it."""

    def __init__(self, body: bytes | tuple, depth: int):
        self.ids, self.held, self.lengths, vocabulary, at = pickle.loads(body) if isinstance(body, bytes) else body
        keys = vocabulary[at]
        n = len(keys)
        begin = np.cumsum(self.lengths) - self.lengths
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.place = np.arange(n) - np.repeat(begin, self.lengths)  # words before the symbol
        order = np.argsort(vocabulary)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.distinct = {1: (vocabulary[order], rank[at])}
        self.training = ~self.held[self.text]
        self.depth = depth
        self.gram, self.count, self.asked = {1: keys}, {}, {1: np.ones(n, bool)}
        self.key, self.kind, self.n_keys = {}, {}, []  # of each order's n-grams: their key's place in its list, the list's number; lengths of lists
        for order in range(2, depth + 2):  # the n-gram that ends with each symbol; where it would begin before the text, it is not used
            self.gram[order] = texts.mix(np.roll(self.gram[order - 1], 1) * np.uint64(3) + keys + np.uint64(order))
        self.asked[2] = self.place >= 1

    def ask(self, orders) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Distinct keys of the n-grams, their number in training texts, the place of each n-gram's key, the n-grams."""
        for order in orders:
            if order - 1 in self.count:
                self.asked[order] = self.before(order - 1) >= 2 if order > 2 else self.asked[2]
            elif order > 2:  # counts of the next shorter ones are asked for at the same time
                self.asked[order] = (self.place >= order - 1) & self.asked[order - 1] & np.roll(self.asked[order - 1], 1)
        at = [np.flatnonzero(self.asked[o]) for o in orders]
        each = [self.distinct.get(o) or np.unique(self.gram[o][a], return_inverse=True) for o, a in zip(orders, at, strict=True)]
        keys = np.concatenate([k for k, _ in each])
        order = np.argsort(keys, kind="stable")  # of lists that are sorted
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        before = np.cumsum([0, *[len(k) for k, _ in each]])
        keys, where = keys[order], np.concatenate([rank[w + b] for (_, w), b in zip(each, before, strict=False)])
        number = np.bincount(where, np.concatenate([self.training[a] for a in at]), len(keys)).astype(np.int64)
        return keys, number, where, at

    def answer(self, orders, sums: np.ndarray) -> None:
        keys, _, where, at = self.ask(orders)
        edge = np.cumsum([0, *map(len, at)])
        for order, a, lo, hi in zip(orders, at, edge, edge[1:], strict=False):
            self.count[order], self.key[order], self.kind[order] = np.zeros(len(self.place), np.int64), np.zeros(len(self.place), np.int32), len(self.n_keys)
            self.count[order][a] = sums[where[lo:hi]]
            self.key[order][a] = where[lo:hi]
        self.n_keys.append(len(keys))

    def before(self, order: int) -> np.ndarray:
        """How often the ``order`` words before each symbol occur in training; 0 where there are fewer or it was not asked."""
        return np.where(self.place >= order, np.roll(self.count[order], 1), 0)

    def levels(self):
        """``(positions, list, key, n, c)`` for each depth: symbols whose context occurs twice, its key's list and place there, its count, the symbol's in it."""
        for d in range(1, self.depth + 1):
            n = self.before(d)
            at = np.flatnonzero(self.asked[d + 1] & (n >= 2))
            yield at, self.kind[d], self.key[d][at - 1], n[at], self.count[d + 1][at]

    def contexts(self) -> list[np.ndarray]:
        """Of each list, the places of keys that are contexts occurring twice."""
        met = [np.zeros(n, bool) for n in self.n_keys]
        for _, kind, key, _, _ in self.levels():
            met[kind][key] = True
        return [np.flatnonzero(m) for m in met]

    def gains(self, root: np.ndarray, weight: float) -> list[np.ndarray]:
        """For each key of each list, what its training occurrences as a context gain over the next shorter context."""
        q = root.copy()
        total = [np.zeros(n, np.int64) for n in self.n_keys]
        for at, kind, key, n, c in self.levels():
            # Of a held-out symbol no gain is counted, but whether its context is retained must be known.
            t = self.training[at]
            new = dealt(np.maximum(c - 1, 0), n - 1, q[at], weight)
            np.add.at(total[kind], key, np.where(t, np.rint(np.log(new / q[at]) * UNIT), 0).astype(np.int64))
            q[at] = new
        return total

    def scores(self, root: np.ndarray, kept: list[np.ndarray], weight: float) -> np.ndarray:
        """Probability of each symbol in its longest retained context; ``kept``: for each key of each list."""
        p = root.copy()
        for at, kind, key, n, c in self.levels():
            use = kept[kind][key]
            p[at[use]] = dealt(c[use], n[use], p[at[use]], weight)
        return p


def dealt(c: np.ndarray, n: np.ndarray, shorter: np.ndarray, weight: float) -> np.ndarray:
    return (c + weight * shorter) / (n + weight)


def learned(code: np.ndarray, symbol: np.ndarray, training: np.ndarray, root: np.ndarray, gain: float, weight: float) -> np.ndarray:
    """log10 of what each occurrence's context makes of its root probability, for contexts of one depth; 0 where it is not retained."""
    _, of_c = np.unique(code, return_inverse=True)
    _, of_p = np.unique(np.stack([of_c, symbol.astype(np.int64)]), axis=1, return_inverse=True)
    of_p = of_p.ravel()
    n, k = np.bincount(of_c, training)[of_c], np.bincount(of_p, training)[of_p]
    others = np.log(dealt(np.maximum(k - 1, 0), np.maximum(n - 1, 0), root, weight) / root)
    kept = np.bincount(of_c, np.where(training, others, 0.0))[of_c] > gain
    return np.where(kept, np.log10(dealt(k, n, root, weight) / root), 0.0)


def _parts(blob: int, keys: np.ndarray, values: np.ndarray, n_buckets: int):
    """Keys and values cut into the buckets, which are ranges of keys."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    edge = np.searchsorted(bucket, np.arange(n_buckets + 1))
    for i in np.flatnonzero(np.diff(edge)):
        lo, hi = edge[i], edge[i + 1]
        yield blob, int(i), _shut((_packed(keys[lo:hi]), _lean(values[lo:hi])))


def _rows(parts, kind: int) -> pa.Table:
    parts = list(parts)
    return pa.table({
        "blob": pa.array([p[0] for p in parts], pa.int64()), "kind": pa.array([kind] * len(parts), pa.int32()),
        "bucket": pa.array([p[1] for p in parts], pa.int32()), "body": pa.array([p[2] for p in parts], pa.binary()),
    })


def _back(group: pa.Table) -> dict:
    """What has come back for a block: by kind, the buckets in order, each with its body opened."""
    rows = sorted(zip(*[group.column(c).to_pylist() for c in ("kind", "bucket", "body")], strict=True), key=lambda r: r[:2])
    back: dict = {}
    for kind, bucket, body in rows:
        back.setdefault(kind, []).append((bucket, _opened(body)))
    return back


def _answered(body: bytes, back: dict, orders: list, depth: int) -> Words:
    """A block's words with the counts that have come back."""
    words = Words(_words_of(body), depth)
    for kind, own in enumerate(orders, 1):
        words.answer(own, np.concatenate([np.zeros(0, np.int64), *[sums for _, (sums, _) in back.get(kind, [])]]))
    return words


def _summed(group: pa.Table) -> pa.Table:
    """One bucket: for each block that asked, the sum of each key over all blocks, and the places of those that are 2 or more."""
    kind = group.column("kind")[0].as_py()
    bodies = [_opened(b) for b in group.column("body").to_pylist()]
    keys = [_unpacked(*k) for k, _ in bodies]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, where, np.concatenate([v.astype(np.int64) for _, v in bodies]))
    often = total >= 2
    place = (np.cumsum(often) - 1).astype(np.uint64)
    edge = np.cumsum([0, *map(len, keys)])
    sums = []
    for lo, hi in zip(edge, edge[1:], strict=False):
        own = where[lo:hi]
        sums.append(_shut((_lean(total[own]), _packed(place[own[often[own]]]))))
    return _rows(zip(group.column("blob").to_pylist(), group.column("bucket").to_pylist(), sums, strict=True), kind)


def _retained(least: float, kinds: int):
    """Task function on one kind and bucket: for each block, whether each of its contexts has gained more than ``least``."""

    def of(group: pa.Table) -> pa.Table:
        bodies = [_opened(b) for b in group.column("body").to_pylist()]
        places = [_unpacked(*k).astype(np.int64) for k, _ in bodies]
        total = np.zeros(max((int(p[-1]) + 1 for p in places if len(p)), default=0), np.int64)
        for place, (_, gained) in zip(places, bodies, strict=True):
            total[place] += _unsigned(*gained)  # a block has each place once
        kept = [_shut(np.packbits(total[p] > least)) for p in places]
        return _rows(zip(group.column("blob").to_pylist(), group.column("bucket").to_pylist(), kept, strict=True), kinds + group.column("kind")[0].as_py())

    return of


def _contexts(words: Words, back: dict) -> list:
    """The block's contexts that occur twice: their list's kind and bucket, their places in the list and among the bucket's keys."""
    found = []
    for kind, at in enumerate(words.contexts(), 1):
        lo = 0
        for bucket, (sums, places) in back.get(kind, []):
            hi = lo + len(sums)
            mine = at[np.searchsorted(at, lo) : np.searchsorted(at, hi)]
            if len(mine):
                nth = np.cumsum(sums >= 2) - 1
                found.append((kind, bucket, mine, _unpacked(*places)[nth[mine - lo]]))
            lo = hi
    return found


def _vocabulary(batches):
    for batch in batches:
        for body in batch.column("body").to_pylist():
            _, held, lengths, vocabulary, at = _words_of(body)
            seen = np.unique(at[np.repeat(~held, lengths)])
            yield pa.RecordBatch.from_arrays([pa.array(vocabulary[seen].view(np.int64))], names=["key"])


def _bucketed(df: DataFrame, by: str, purpose: str, to: str | None = None) -> str:
    """Name of a table with the rows of ``df``, added to those of ``to``, laid out by a hash of ``by``: grouping by it needs no shuffle."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(n, by).write
    if to is not None:
        rows.insertInto(to)
        return to
    name = f"{purpose}_{uuid.uuid4().hex}"
    rows.format("parquet").bucketBy(n, by).option("path", shared_folder(spark, purpose)).saveAsTable(name)
    return name


@contextmanager
def _short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of jobs that run inside are removed when the job has ended; the setting is put back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, had)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(
    docs: DataFrame, held_out: Column, depth: int = DEPTH, gain: float = GAIN, weight: float = WEIGHT, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out``: condition on ``docs``; the other rows are learned from.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    split = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out"))
    orders = [o for o in ([1, 2], [3][: depth - 1], list(range(4, depth + 2))) if o]

    def root(block: Words) -> np.ndarray:
        return (block.count[1] + 0.5) / norm

    def first(batches):
        for batch in batches:
            for blob, body in zip(batch.column("blob").to_pylist(), batch.column("body").to_pylist(), strict=True):
                keys, number, _, _ = Words(_words_of(body), depth).ask(orders[0])
                yield from _rows(_parts(blob, keys, number, n_buckets[0]), 1).to_batches()

    def longer(known: int):
        def of(block: pa.Table, sums: pa.Table) -> pa.Table:
            blob, body = (block.column(c)[0].as_py() for c in ("blob", "body"))
            keys, number, _, _ = _answered(body, _back(sums), orders[:known], depth).ask(orders[known])
            return _rows(_parts(blob, keys, number, n_buckets[known]), known + 1)

        return of

    def gains(block: pa.Table, sums: pa.Table) -> pa.Table:
        blob, body = (block.column(c)[0].as_py() for c in ("blob", "body"))
        back = _back(sums)
        words = _answered(body, back, orders, depth)
        gained = words.gains(root(words), weight)
        parts: list = [[] for _ in orders]
        for kind, bucket, at, place in _contexts(words, back):
            parts[kind - 1].append((blob, bucket, _shut((_packed(place), _signed(gained[kind - 1][at])))))
        return pa.concat_tables([_rows(p, kind) for kind, p in enumerate(parts, 1)])

    def last(block: pa.Table, sums: pa.Table) -> pa.Table:
        back = _back(sums)
        words = _answered(block.column("body")[0].as_py(), back, orders, depth)
        kept = [np.zeros(n, bool) for n in words.n_keys]
        bits = {(kind, bucket): b for kind in back if kind > len(orders) for bucket, b in back[kind]}
        for kind, bucket, at, _ in _contexts(words, back):
            kept[kind - 1][at] = np.unpackbits(bits[kind + len(orders), bucket], count=len(at)).astype(bool)
        p = root(words)
        n = len(words.lengths)
        return pa.table({
            "doc_id": words.ids, "held_out": pa.array(words.held, pa.bool_()), "n_tokens": pa.array(words.lengths, pa.int64()),
            "n_known": pa.array(np.bincount(words.text, words.count[1] > 0, n).astype(np.int64)),
            "base_score": np.bincount(words.text, np.log10(p), n),
            "score": np.bincount(words.text, np.log10(words.scores(p, kept, weight)), n),
        })

    def with_blocks(sums: DataFrame, task, schema: str) -> DataFrame:
        return blocks.select("blob", "body").groupBy("blob").cogroup(sums.groupBy("blob")).applyInArrow(task, schema)

    with _short_lived_shuffles(spark):
        blocks = spark.table(_bucketed(split.mapInArrow(_blocks(max(1, bucket // 4)), BODY), "blob", "blocks"))
        words, total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
        distinct = blocks.select("body").mapInArrow(_vocabulary, "key long").distinct().count()
        norm = total + 0.5 * (distinct + 1)
        n_buckets = [int(max(1, -(-words * len(o) // bucket))) for o in orders]
        asked = blocks.select("blob", "body").mapInArrow(first, BLOCK)
        known = _bucketed(asked.groupBy("bucket").applyInArrow(_summed, BLOCK), "blob", "sums")
        for n in range(1, len(orders)):
            asked = with_blocks(spark.table(known), longer(n), BLOCK)
            _bucketed(asked.groupBy("bucket").applyInArrow(_summed, BLOCK), "blob", "sums", known)
        gained = with_blocks(spark.table(known), gains, BLOCK).groupBy("kind", "bucket")
        _bucketed(gained.applyInArrow(_retained(gain * UNIT, len(orders)), BLOCK), "blob", "sums", known)
    scored = with_blocks(spark.table(known), last, SCORED)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
