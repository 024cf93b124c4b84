"""Suffix-array de-duplication of long repeated strings.

Every string of ``length`` bytes that starts in two places is found, in one
document or in two; matches never cross documents. ``keep="first"`` removes it
everywhere but where it starts first (by doc_id, then place); ``keep="none"``
removes every occurrence. Strings are judged on the input, and overlapping
ones count.

Equal strings meet like this. Each window of ``length`` bytes is told by the
least hashed ``GRAM``-byte string inside it (leftmost if equal), so equal
windows have the same one; the windows in a row with the same one are a piece.
Pieces whose key is met once go. Equal pieces of a key are counted; one of
them, the first, stands for them. Copies of very common pieces are marked by a
bounded list that travels to the tasks, others by a join. Keys with several different pieces are
compared by a suffix array over their pieces: suffixes are sorted by doubling
ranks up to ``length`` bytes, common prefixes of neighbours follow from the
ranks, and the longest previous factor of each place from the previous and next
smaller places in suffix order (``keep="none"`` also takes the longest later
factor, the same with places counted backwards). Many keys share an array of a
few megabytes. A key with more than ``many`` different pieces is not put into
one array; its windows are counted by key and hash over all tasks, which gives
the same answer.

Cases: a null text is empty; a text below ``length`` bytes has nothing to
remove. Rows with the same doc_id and text are one place for ``keep="first"``
and two for ``keep="none"``; they are folded before pieces are compared, and
their spans once more before they are applied. A null doc_id comes first in
order. A very long text is one block of a task, cut into its pieces like
others. An empty table has no spans. Extra columns are kept by ``apply_spans``
and not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewater.llm import texts
from tracewater.llm.common import bound_batches, fresh, plain_names, stage

LENGTH, GRAM, MANY, HOT = 200, 32, 2000, 100_000
_PLACE = np.uint64((1 << 28) - 1)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` values in a row, from running minima of blocks in both directions."""
    n = len(v) - w + 1
    padded = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(v)] = v
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _anchors(hashed: np.ndarray, w: int, stretch: int = 1 << 27) -> np.ndarray:
    """Place of the least of each ``w`` hashes in a row, leftmost if equal.

    The hash's upper bits and the place share a number, so places count within
    stretches of fewer than 2**28; a longer text has several.
    """
    out = []
    for lo in range(0, len(hashed) - w + 1, stretch):
        part = hashed[lo : lo + stretch + w - 1]
        least = _sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), w)
        out.append((least & _PLACE).astype(np.int64) + lo)
    return np.concatenate(out)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``text, start, windows, key, content`` of the block's pieces; starts count in the block."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length + 1:
        return none
    sums = texts.prefix(data)
    at = np.arange(len(data) - gram + 1)
    hashed = texts.stretch_hash(sums, at, at + gram)
    anchors = _anchors(hashed, length - gram + 1)
    ends = np.repeat(offsets[1:] - 1, np.diff(offsets))  # a text ends before its space
    good = np.zeros(len(anchors), bool)
    inside = np.arange(1, min(len(anchors), offsets[-1]))
    good[inside] = inside + length <= ends[inside - 1]
    p = np.flatnonzero(good)
    if not len(p):
        return none
    anchor = anchors[p]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)]))
    start = p[first]
    windows = np.diff(np.append(first, len(p)))
    text = np.searchsorted(offsets, start, "right") - 1
    return text, start, windows, hashed[anchor[first]], texts.stretch_hash(sums, start, start + windows + length - 1)


def _keys(length: int, gram: int):
    def of(batches):
        for _, data, offsets in texts.blocks(batches):
            key, n = np.unique(pieces(data, offsets, length, gram)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    return of


PIECES = "doc_id long, text_hash long, start long, windows long, key long, content long"
PIECE_NAMES = ["doc_id", "text_hash", "start", "windows", "key", "content"]


def _pieces(length: int, gram: int):
    def of(batches):
        for rows, data, offsets in texts.blocks(batches):
            text, start, windows, key, content = pieces(data, offsets, length, gram)
            own = rows.select(["doc_id", "text_hash"]).take(pa.array(text))
            yield texts.table(
                own, ["doc_id", "text_hash"], start=start - offsets[text], windows=windows,
                key=key.view(np.int64), content=content.view(np.int64),
            )

    return of


CUT = "key long, doc_id long, text_hash long, start long, windows long, body binary"


def _cut(length: int):
    """Cut the wanted pieces out of the texts."""

    def of(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("text")[i].as_py().encode()
                wanted = batch.column("wanted")[i].as_py()
                n = len(wanted)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([w["key"] for w in wanted], pa.int64()),
                            pa.array([batch.column("doc_id")[i].as_py()] * n, pa.int64()),
                            pa.array([batch.column("text_hash")[i].as_py()] * n, pa.int64()),
                            pa.array([w["start"] for w in wanted], pa.int64()),
                            pa.array([w["windows"] for w in wanted], pa.int64()),
                            pa.array([raw[w["start"] : w["start"] + w["windows"] + length - 1] for w in wanted], pa.binary()),
                        ],
                        names=["key", "doc_id", "text_hash", "start", "windows", "body"],
                    )

    return of


def suffix_order(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the ``length``-byte strings in the order of their bytes, and the common prefix with the one before.

    ``ends``: where the piece of each place ends. Ranks double in length: a
    rank tells a place's next 1, 2, 4, ... bytes; a string's rank follows from
    two overlapping ones.
    """
    ranks, wide = [data.astype(np.int64)], 1
    room = ends - np.arange(len(data))
    while 2 * wide <= length:
        last = ranks[-1]
        nxt = np.full(len(data), -1)
        at = np.flatnonzero(room >= 2 * wide)
        if wide < 4:  # still few values: ranks are the bytes themselves
            nxt[at] = (last[at] << (8 * wide)) | last[at + wide]
        else:
            pair = last[at] * (int(last.max(initial=0)) + 1) + last[at + wide] if wide > 4 else (last[at].astype(np.uint64) << np.uint64(32)) | last[at + wide].astype(np.uint64)
            nxt[at] = np.unique(pair, return_inverse=True)[1]
        ranks.append(nxt)
        wide *= 2
    at = np.flatnonzero(room >= length)
    top = ranks[-1]
    value = top[at] * (int(top.max(initial=0)) + 1) + top[at + length - wide]
    order = at[np.argsort(value, kind="stable")]
    shared = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    same = np.zeros(len(a), np.int64)
    if len(a):
        whole = (top[a] == top[b]) & (top[a + length - wide] == top[b + length - wide])
        for k in range(len(ranks) - 1, -1, -1):
            rank, step = ranks[k], 1 << k
            fits = same + step <= length
            x, y = np.where(fits, a + same, a), np.where(fits, b + same, b)
            same += np.where(fits & (rank[x] == rank[y]) & (rank[x] >= 0), step, 0)
        shared[1:] = np.where(whole, length, np.minimum(same, length - 1))
    return order, shared


def previous_factors(order: np.ndarray, shared: np.ndarray, place: np.ndarray, enough: int) -> np.ndarray:
    """For each row of the suffix order the longest match at a smaller place, as far as it reaches ``enough``.

    The nearest row with a smaller place is sought on both sides by following
    pointers; the match with it is the least common prefix on the way. A search
    ends where that falls below ``enough``.
    """
    best = np.zeros(len(order), np.int64)
    for back in (False, True):
        p = place[::-1] if back else place
        step = np.concatenate([shared[1:][::-1], [0]]) if back else shared
        step = np.concatenate([[0], step[:-1]]) if back else step
        to, least = np.arange(-1, len(p) - 1), step.copy()
        if len(p):
            least[0] = 0
        open_ = np.flatnonzero((least >= enough) & (to >= 0))
        open_ = open_[p[to[open_]] > p[open_]]
        while len(open_):
            via = to[open_]
            far, low = to[via], np.minimum(least[open_], least[via])
            to[open_], least[open_] = far, low
            alive = (low >= enough) & (far >= 0)
            open_ = open_[alive]
            open_ = open_[p[to[open_]] > p[open_]]
        found = np.where((to >= 0) & (least >= enough), least, 0)
        best = np.maximum(best, found[::-1] if back else found)
    return best


def _spans_of(flagged: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the windows at the flagged starts."""
    at = np.flatnonzero(flagged)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.concatenate([[0], gap + 1])].tolist(), (at[np.append(gap, len(at) - 1)] + length).tolist(), strict=True))


SPAN = "doc_id long, text_hash long, lo long, hi long"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_hash", "lo", "hi"])


def _compare(length: int, keep: str, size: int = 1 << 20):
    """Suffix arrays over the pieces of many keys; rows come sorted by key."""

    def matched(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))  # places in order of doc_id, text, start
        bodies = [r[5] for r in rows]
        data = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.array([len(b) for b in bodies])
        stops = np.cumsum(sizes)
        order, shared = suffix_order(data, np.repeat(stops, sizes), length)
        hit = np.zeros(len(data), bool)
        hit[order[previous_factors(order, shared, order, length) >= length]] = True
        if keep == "none":
            hit[order[previous_factors(order, shared, -order, length) >= length]] = True
        out = []
        for row, stop, n in zip(rows, stops, sizes, strict=True):
            for lo, hi in _spans_of(hit[stop - n : stop], length):
                out.append((row[1], row[2], row[3] + lo, row[3] + hi))
        return _span_batch(out)

    def of(batches):
        held, have = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if have >= size and row[0] != held[-1][0]:
                    yield matched(held)
                    held, have = [], 0
                held.append(row)
                have += len(row[5])
        if held:
            yield matched(held)

    return of


WINDOW = "key long, content long, doc_id long, text_hash long, start long"


def _windows(length: int):
    """The windows of pieces one by one."""

    def of(batches):
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = np.frombuffer(row[5], np.uint8)
                at = np.arange(row[4])
                content = texts.stretch_hash(texts.prefix(data), at, at + length).view(np.int64)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]] * n, pa.int64()), pa.array(content), pa.array([row[1]] * n, pa.int64()),
                     pa.array([row[2]] * n, pa.int64()), pa.array(at + row[3])],
                    names=["key", "content", "doc_id", "text_hash", "start"],
                )

    return of


def _once(hashed: DataFrame, lists: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text, wanted``: the text of each of ``lists``, once, however many rows have it.

    Texts of single rows are joined as they are; only repeated rows are folded,
    in their tasks before they move.
    """
    who = F.struct("doc_id", "text_hash").alias("who")  # structs with equal nulls are equal
    rows = hashed.select(who, "text")
    wanted = lists.select(who, "wanted")
    twice = stage(hashed.groupBy(who).agg(F.count("*").alias("n")).filter("n > 1").select("who"), "twice")
    found = rows.join(wanted.join(twice, "who", "left_anti"), "who")
    if twice.limit(1).count():
        again = rows.join(wanted.join(twice, "who", "left_semi"), "who")
        found = found.unionByName(again.groupBy("who").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted")))
    return found.select("who.*", "text", "wanted")


def _marked(shared, length: int, keep: str):
    """Task function: spans of pieces whose content is in the broadcast list (content and key -> first place).

    Pieces in a row overlap, so a passage of several pieces that are removed
    gives one span where they come in the order of their text.
    """

    def of(batches):
        hot = shared.value
        contents = np.array(sorted({c for c, _ in hot}), np.int64)
        run = None
        for batch in batches:
            own = batch.column("content").to_numpy()
            at = np.minimum(np.searchsorted(contents, own), len(contents) - 1)
            may = batch.filter(pa.array(contents[at] == own))
            out = []
            for doc, text, start, windows, key, content in zip(*[may.column(c).to_pylist() for c in PIECE_NAMES], strict=True):
                first = hot.get((content, key))
                if first is None or (keep == "first" and first == (doc, text, start)):
                    continue
                hi = start + windows + length - 1
                if run and run[:2] == (doc, text) and run[2] <= start <= run[3]:
                    run = (doc, text, run[2], max(run[3], hi))
                else:
                    if run:
                        out.append(run)
                    run = (doc, text, start, hi)
            yield _span_batch(out)
        if run:
            yield _span_batch([run])

    return of


def _copies(shared: DataFrame, kinds: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans of the pieces that stand more than once, but for the first with ``keep="first"``.

    Contents that are more than one of ``HOT`` of all pieces, hence fewer than
    ``HOT``, travel to the tasks; pieces with others meet theirs in a join.
    """
    place = F.struct("doc_id", "text_hash", "start")
    total = kinds.agg(F.sum("n")).first()[0] or 0
    again = kinds.filter("n > 1").select("key", "content", "first", (F.col("n") * HOT > total).alias("hot"))
    hot = {(r.content, r.key): tuple(r.first) for r in again.filter("hot").collect()}
    copies = shared.join(again.filter("not hot").drop("hot"), ["key", "content"])
    if keep == "first":
        copies = copies.filter(~place.eqNullSafe(F.col("first")))
    spans = copies.select("doc_id", "text_hash", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + length - 1).alias("hi"))
    if hot:
        known = shared.sparkSession.sparkContext.broadcast(hot)
        spans = spans.unionByName(shared.select(*PIECE_NAMES).mapInArrow(_marked(known, length, keep), SPAN))
    return spans


def repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", gram: int = GRAM, many: int = MANY) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, text_hash, lo, hi``: byte spans to remove, which may overlap."""
    if keep not in ("first", "none"):
        raise ValueError(keep)
    bound_batches(docs.sparkSession)
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    key_counts = hashed.select("text").mapInArrow(_keys(length, gram), "key long, n long")
    met = stage(key_counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"), "keys")
    all_pieces = hashed.mapInArrow(_pieces(length, gram), PIECES)
    shared = stage(all_pieces.join(met, "key"), "pieces")
    place = F.struct("doc_id", "text_hash", "start")
    kinds = stage(
        shared.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.first("windows").alias("windows")), "kinds"
    )
    whole = _copies(shared, kinds, length, keep)

    per_key = stage(kinds.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "mixed")
    wanted = kinds.join(per_key, "key").select("key", "first.*", "windows")
    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "start", "windows")).alias("wanted"))
    cut = stage(_once(hashed, lists).mapInArrow(_cut(length), CUT), "cut")
    columns = ["key", "doc_id", "text_hash", "start", "windows", "body"]
    few = cut.join(per_key.filter(F.col("kinds") <= many), "key").select(columns)
    by_key = few.repartition("key").sortWithinPartitions("key")
    compared = by_key.mapInArrow(_compare(length, keep), SPAN)

    lots = cut.join(per_key.filter(F.col("kinds") > many), "key").select(columns)
    single = stage(lots.mapInArrow(_windows(length), WINDOW), "windows")
    counted = single.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    counted = stage(counted, "counted")
    hot = single.join(counted, ["key", "content"])
    if keep == "first":
        hot = hot.filter(~place.eqNullSafe(F.col("first")))
    hot = hot.select("doc_id", "text_hash", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))
    return whole.unionByName(compared).unionByName(hot)


def _joined(spans: list[dict], n: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _applied(columns: list[str], name: str, digest: bool):
    def of(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                n_bytes, n_removed, n_spans, kept = [], [], [], []
                for text, spans in zip(part.column("text"), part.column(name), strict=True):
                    raw = (text.as_py() or "").encode()
                    cut = _joined(spans.as_py(), len(raw))
                    edges = [0, *[x for s in cut for x in s], len(raw)]
                    left = [raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    n_bytes.append(len(raw))
                    n_removed.append(sum(hi - lo for lo, hi in cut))
                    n_spans.append(len(cut))
                    if digest:
                        kept.append(hashlib.sha256(b"".join(left)).hexdigest())
                    elif cut:  # a character cut in half goes
                        kept.append("".join(x.decode(errors="ignore") for x in left))
                    else:
                        kept.append(text.as_py())
                if digest:
                    yield texts.table(part, ["doc_id"], n_bytes=n_bytes, n_removed=n_removed, n_spans=n_spans, kept_sha256=pa.array(kept, pa.string()))
                else:
                    arrays = [pa.array(kept, pa.string()) if c == "text" else part.column(c) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return of


def _with_spans(docs: DataFrame, spans: DataFrame, name: str) -> DataFrame:
    lists = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi")).alias(name))  # repeated rows give equal spans
    own = lists.select(F.col("doc_id").alias("b_doc"), F.col("text_hash").alias("b_text"), name).alias("b")
    hashed = F.xxhash64(F.coalesce(F.col("a.text"), F.lit("")))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.b_doc")) & (hashed == F.col("b.b_text"))
    return docs.alias("a").join(own, same, "left").select("a.*", f"b.{name}")


def apply_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut out of ``text``; all its columns, in order."""
    docs, named = plain_names(docs)
    name = fresh(docs, "spans")
    return named(_with_spans(docs, spans, name).mapInArrow(_applied(docs.columns, name, False), docs.schema))


def removal_report(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row, of the exact bytes."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_spans(docs.select("doc_id", "text"), spans, "spans").mapInArrow(_applied([], "spans", True), schema)
