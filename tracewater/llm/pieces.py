"""SentencePiece merges with seeded dropout: encoding, and decoding without loss.

The vocabulary is that of a SentencePiece model of the merge type with byte
fallback; its path is a parameter, and the driver reads it once and sends the
tables along. A text gets one blank in front and is cut into chunks, blanks and
what follows them, since no piece of the vocabulary holds a blank behind
another character. In a chunk the agenda takes candidate merges by score, the
leftmost of equal ones first. With ``dropout`` above 0 a candidate, told by
where its two parts start and end, is skipped for good when a hash keyed by
``seed``, doc_id, the text, the row's number among equal rows and the chunk's
place in the text falls below it; so every occurrence of a word is drawn anew
and reruns agree. With ``dropout`` 0 the result is the model's own encoding.
Characters outside the vocabulary, and the character that stands for a blank in
the vocabulary, become byte pieces, so decoding gives back every text.

Without dropout a chunk is encoded once per block of texts, else at each
occurrence. Those of up to ``WIDE``
characters run their agendas in step, as rows of a matrix; longer ones, which
would take as many steps as merges, each run a heap.

Cases: a null or empty text has no pieces and decodes to the empty text. A null
doc_id is a key of its own. Other columns pass through; a column named
``ids`` (``decoded``) is replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, fresh, plain_names, stage

BLANK_MARK = "▁"
WIDE = 32
NONE = np.int32(1 << 30)


def load(model_file: str) -> dict:
    """Tables of the model: piece bytes by id, merges by pair, ids of characters and bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    plain = {
        names[i]: i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }
    if any(BLANK_MARK in p.lstrip(BLANK_MARK) for p in plain):
        raise ValueError("a piece holds a blank behind another character")
    rank = {p: r for r, p in enumerate(sorted(plain, key=lambda p: (-model.get_score(plain[p]), plain[p])))}
    symbols = dict(plain)
    for p in plain:  # characters that only stand inside pieces are symbols, too
        for c in p:
            symbols.setdefault(c, n + len(symbols) - len(plain))
    left, right, made, order = [], [], [], []
    for p, i in plain.items():
        for k in range(1, len(p)):
            if p[:k] in symbols and p[k:] in symbols:
                left.append(symbols[p[:k]])
                right.append(symbols[p[k:]])
                made.append(i)
                order.append(rank[p])
    chars = np.full(0x110000, -1, np.int32)
    for p, i in symbols.items():
        if len(p) == 1:
            chars[ord(p)] = i
    chars[0x20] = symbols.get(BLANK_MARK, -1)
    chars[ord(BLANK_MARK)] = -1
    byte_ids = np.full(256, -1, np.int32)
    decoded: list[bytes] = [b""] * n
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
            decoded[i] = bytes([int(names[i][3:5], 16)])
        elif names[i] in plain:
            decoded[i] = names[i].replace(BLANK_MARK, " ").encode()
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback")
    outside = {s: ord(c) for c, s in symbols.items() if s >= n}
    key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
    bits = max(4, int(np.ceil(np.log2(4 * max(1, len(key))))))
    slots = np.full(1 << bits, -1, np.int64)
    at = np.zeros(1 << bits, np.int32)
    for k, x in enumerate(key.tolist()):
        s = (x * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - bits)
        while slots[s] >= 0:
            s = (s + 1) % (1 << bits)
        slots[s], at[s] = x, k
    return {
        "slots": slots, "at": at, "bits": bits, "made": np.array(made, np.int32), "order": np.array(order, np.int32),
        "chars": chars, "bytes": byte_ids, "decoded": decoded, "outside": outside,
    }


def merge_of(t: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and id of the merge of each pair; rank ``NONE`` where there is none."""
    rank, made = np.full(left.shape, NONE, np.int32), np.zeros(left.shape, np.int32)
    open_ = np.flatnonzero((left >= 0) & (right >= 0))
    key = left[open_].astype(np.int64) << 32 | right[open_].astype(np.int64)
    slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - t["bits"])).astype(np.int64)
    while len(open_):
        there = t["slots"][slot]
        hit = there == key
        found = t["at"][slot[hit]]
        rank[open_[hit]], made[open_[hit]] = t["order"][found], t["made"][found]
        go = ~hit & (there >= 0)
        open_, key, slot = open_[go], key[go], (slot[go] + 1) % (1 << t["bits"])
    return rank, made


def skipped(keys: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    told = (start.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
    return texts.mix(keys ^ texts.mix(told)) < np.uint64(min(dropout, 1 - 2**-53) * 2.0**64)


def _in_step(t: dict, points: np.ndarray, sizes: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of chunks given as rows of code points: padded rows and their numbers."""
    m, wide = points.shape
    ids = t["chars"][points]
    ids = np.where(ids < 0, -points - 2, ids).astype(np.int32)  # outside the vocabulary: told by the code point
    span = np.arange(wide + 1, dtype=np.int32)
    ids[span[None, :-1] >= sizes[:, None]] = -1
    begin = np.minimum(span[None, :], sizes[:, None]).astype(np.int32)  # where each symbol starts
    count = sizes.astype(np.int64).copy()
    out = ids.copy()
    if wide < 2:
        return out, count

    def ranked(rows, left, right, start, mid, end):
        rank, made = merge_of(t, left, right)
        if dropout > 0:
            at = np.flatnonzero(rank < NONE)
            at = at[skipped(keys[rows[at]], start[at], mid[at], end[at], dropout)]
            rank[at] = NONE
        return rank, made

    every = np.repeat(np.arange(m), wide - 1)
    rank, made = ranked(
        every, ids[:, :-1].ravel(), ids[:, 1:].ravel(), begin[:, :-2].ravel(), begin[:, 1:-1].ravel(), begin[:, 2:].ravel()
    )
    rank, made, live = rank.reshape(m, -1), made.reshape(m, -1), np.arange(m)
    columns = np.arange(wide)
    while True:
        best = rank.argmin(axis=1)
        going = rank[np.arange(len(live)), best] < NONE
        if not going.all():
            out[live[~going]] = ids[~going]
            ids, begin, rank, made, live, best = ids[going], begin[going], rank[going], made[going], live[going], best[going]
        if not len(live):
            return out, count
        row = np.arange(len(live))
        ids[row, best] = made[row, best]
        # Drop the symbol right of the merged one, and what was known of its two pairs.
        take = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), wide - 1)
        ids = np.take_along_axis(ids, take, 1)
        ids[:, -1] = -1
        later = np.minimum(span[None, :] + (span[None, :] > best[:, None]), wide)
        begin = np.take_along_axis(begin, later, 1)
        count[live] -= 1
        pair = np.minimum(columns[None, :-1] + (columns[None, :-1] > best[:, None]), wide - 2)
        rank, made = np.take_along_axis(rank, pair, 1), np.take_along_axis(made, pair, 1)
        rank[:, -1] = NONE
        for j in (best - 1, best):
            at = np.flatnonzero((j >= 0) & (j < wide - 1))
            k = j[at]
            r, i = ranked(live[at], ids[at, k], ids[at, k + 1], begin[at, k], begin[at, k + 1], begin[at, k + 2])
            rank[at, k], made[at, k] = r, i


def _agenda(t: dict, points: np.ndarray, key: np.uint64, dropout: float) -> np.ndarray:
    """One chunk's symbols by a heap of candidates."""
    n = len(points)
    ids = t["chars"][points]
    ids = np.where(ids < 0, -points - 2, ids).astype(np.int32)
    before, after, begin = np.arange(-1, n - 1), np.arange(1, n + 1), np.arange(n + 1)
    heap: list = []
    keys = np.array([key], np.uint64)

    def push(i_list):
        i = np.array([x for x in i_list if x >= 0 and after[x] < n], np.int64)
        if not len(i):
            return
        j = after[i]
        end = begin[after[j]]
        rank, made = merge_of(t, ids[i], ids[j])
        ok = rank < NONE
        if dropout > 0:
            ok &= ~skipped(np.repeat(keys, len(i)), begin[i], begin[j], end, dropout)
        for x in np.flatnonzero(ok):
            heapq.heappush(heap, (int(rank[x]), int(i[x]), int(j[x]), int(end[x]), int(made[x])))

    push(range(n))
    gone = np.zeros(n + 1, bool)
    while heap:
        _, i, j, end, made = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j or begin[after[j]] != end:
            continue
        ids[i], gone[j] = made, True
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push([before[i], i])
    return ids[~gone[:n]]


def encode_chunks(t: dict, points: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray, dropout: float) -> list[np.ndarray]:
    """Symbols of the chunks ``points[start:end]``: values and, with one more entry, where each chunk's begin."""
    sizes = end - start
    values, owner, nth = [], [], []
    low = 0
    for wide in (4, 8, 12, 20, WIDE):
        at = np.flatnonzero((sizes > low) & (sizes <= wide))
        low = wide
        for part in np.array_split(at, max(1, -(-len(at) // 20_000))):
            if not len(part):
                continue
            index = np.minimum(start[part][:, None] + np.arange(wide), len(points) - 1)
            rows, count = _in_step(t, points[index], sizes[part], keys[part], dropout)
            use = np.arange(wide)[None, :] < count[:, None]
            values.append(rows[use])
            owner.append(np.repeat(part, count))
            nth.append(np.nonzero(use)[1])
    for i in np.flatnonzero(sizes > WIDE):
        got = _agenda(t, points[start[i] : end[i]], keys[i], dropout)
        values.append(got)
        owner.append(np.full(len(got), i))
        nth.append(np.arange(len(got)))
    if not values:
        return [np.zeros(0, np.int32), np.zeros(len(start) + 1, np.int64)]
    value, own, place = np.concatenate(values), np.concatenate(owner), np.concatenate(nth)
    value = value[np.lexsort((place, own))]
    own = np.sort(own)
    value, own = _as_bytes(t, value, own)
    return [value, np.searchsorted(own, np.arange(len(start) + 1))]


def _as_bytes(t: dict, value: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace symbols outside the vocabulary by byte pieces."""
    n = len(t["decoded"])
    bad = np.flatnonzero((value < 0) | (value >= n))
    if not len(bad):
        return value, own
    point = np.array([t["outside"][int(v)] if v >= n else -int(v) - 2 for v in value[bad]], np.uint32)
    raw = [chr(c).encode() for c in point]
    times = np.ones(len(value), np.int64)
    times[bad] = [len(r) for r in raw]
    out, own = np.repeat(value, times), np.repeat(own, times)
    first = np.cumsum(times) - times
    flat = np.frombuffer(b"".join(raw), np.uint8)
    at = np.repeat(first[bad], times[bad]) + np.concatenate([np.arange(len(r)) for r in raw])
    out[at] = t["bytes"][flat]
    return out, own


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = int(n.sum())
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(total)


def encode_block(t: dict, data: np.ndarray, offsets: np.ndarray, salt: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, and where each text's begin; ``salt``: a 64-bit key for each text's draws."""
    n_texts = len(offsets) - 1
    filled = np.diff(offsets) > 1
    body = data[:-1]  # the space after the last text belongs to none
    points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    char = np.cumsum((data & 0xC0) != 0x80) - 1  # character of each byte
    head = offsets[:-1] - 1  # each text's blank in front
    is_blank = data == 0x20
    starts = is_blank.copy()
    starts[1:] &= ~is_blank[:-1]
    starts[head[filled]] = True
    at = np.flatnonzero(starts)
    text = np.searchsorted(head, at, "right") - 1
    stop = offsets[1:][text] - 1
    keep = filled[text] & (at < stop)
    at, text, stop = at[keep], text[keep], stop[keep]
    ends = np.minimum(np.append(at[1:], len(data)), stop)
    if dropout > 0:
        keys = texts.mix(texts.mix(salt)[text] + (at - head[text]).astype(np.uint64))
        first = where = np.arange(len(at))
    else:
        keys, first, where = np.unique(texts.stretch_hash(texts.prefix(data), at, ends), return_index=True, return_inverse=True)
    values, begin = encode_chunks(t, points, char[at[first]], np.append(char, len(points))[ends[first]], keys, dropout)
    number = np.diff(begin)[where]
    ids = values[_ranges(begin[:-1][where], number)]
    per_text = np.bincount(text, weights=number, minlength=n_texts).astype(np.int64)
    return ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(per_text)])


def _encoded(shared, columns: list[str], name: str, dropout: float):
    def of(batches):
        t = shared.value
        for rows, data, offsets in texts.blocks(batches):
            salt = rows.column(name).to_numpy(zero_copy_only=False).view(np.uint64)
            ids, begin = encode_block(t, data, offsets, salt, dropout)
            lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield texts.table(rows, columns, ids=lists)

    return of


def _placed(key: str, columns: list[str], place: str, part: str):
    """Task function: rows with their number among the task's rows of equal ``key``, and the task's number."""

    def of(batches):
        seen: dict = {}
        for batch in batches:
            number = []
            for k in batch.column(key).to_pylist():
                number.append(seen.get(k, 0))
                seen[k] = number[-1] + 1
            task = np.full(batch.num_rows, TaskContext.get().partitionId(), np.int64)
            yield texts.table(batch, columns, **{place: pa.array(number, pa.int64()), part: task})

    return of


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``, a row's number (from 0) among the rows of its doc_id and text.

    A task numbers its own rows and starts behind those of the tasks before, so no group of copies meets in one task.
    """
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    if not keyed.groupBy(key).count().filter("count > 1").limit(1).count():
        return docs.withColumn(name, F.lit(0).cast("long"))
    place, part = fresh(keyed, "_place"), fresh(keyed, "_part")
    schema = T.StructType([*keyed.schema.fields, T.StructField(place, T.LongType()), T.StructField(part, T.LongType())])
    rows = stage(keyed.mapInArrow(_placed(key, keyed.columns, place, part), schema), "copies")
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before, n = fresh(rows, "_before"), fresh(rows, "_n")
    sizes = rows.groupBy(key, part).agg(F.count("*").alias(n)).withColumn(before, F.sum(n).over(earlier)).filter(F.col(before) > 0)
    found = rows.join(sizes.drop(n), [key, part], "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(place) + F.coalesce(before, F.lit(0))).alias(name))


def encode(docs: DataFrame, tables: dict, dropout: float = 0.1, seed: int = 7) -> DataFrame:
    """``docs`` with ``ids``, the pieces of ``text``."""
    bound_batches(docs.sparkSession)
    plain, named = plain_names(docs.drop("ids"))
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    name = fresh(plain, "salt")
    rows = numbered(plain, name) if dropout > 0 else plain.withColumn(name, F.lit(0).cast("long"))
    salt = F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "text", name)
    return named(rows.withColumn(name, salt).mapInArrow(_encoded(shared, plain.columns, name, dropout), schema))


def _decoded(shared, columns: list[str]):
    def of(batches):
        piece = shared.value
        for batch in batches:
            ids = batch.column("ids")
            out = []
            for i in range(batch.num_rows):
                values = ids[i].values
                raw = b"".join([piece[x] for x in values.to_numpy(zero_copy_only=False).tolist()]) if values is not None else b""
                out.append(raw[1:].decode())
            yield texts.table(batch, columns, decoded=pa.array(out, pa.string()))

    return of


def decode(encoded: DataFrame, tables: dict) -> DataFrame:
    """``encoded`` with ``decoded``, the text its ``ids`` stand for."""
    plain, named = plain_names(encoded.drop("decoded"))
    shared = encoded.sparkSession.sparkContext.broadcast(tables["decoded"])
    return named(plain.mapInArrow(_decoded(shared, plain.columns), T.StructType([*plain.schema.fields, T.StructField("decoded", T.StringType())])))
