"""Whole texts as numpy byte arrays inside tasks: blocks of rows, words, hashes.

Everything here works on one Arrow batch, cut into blocks of a few megabytes,
so a task's memory does not depend on the table; a longer single text is a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2 << 20
_U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value (splitmix finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x += _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE = mix(np.arange(256, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    have, step = 1, base
    while have < n:  # doubling: the second half is the first times base**have
        m = min(have, n - have)
        np.multiply(out[:m], _U(step), out=out[have : have + m])
        have, step = have + m, step * step % (1 << 64)
    return out


_POWERS: dict = {}


def powers_to(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        if n > 4 * BLOCK:
            return powers(base, n)
        _POWERS[base] = powers(base, max(n, 1 << 16))
    return _POWERS[base][:n]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK) -> Iterator[tuple]:
    """``(rows, data, offsets)``: a slice of a batch, its texts' bytes with a space after each, where they start and end.

    Text ``i`` is ``data[offsets[i]:offsets[i + 1] - 1]``. ``data[-1]`` and what stands before text 0 are spaces, too:
    ``data`` begins with one space that belongs to no text.
    """
    for batch in batches:
        text = pc.fill_null(batch.column(column), "").cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + size, "right")))
            part = text.slice(lo, hi - lo)
            spaced = pc.binary_join_element_wise(part, *[pa.scalar(x, pa.large_string()) for x in ("", " ")])
            if isinstance(spaced, pa.ChunkedArray):
                spaced = spaced.combine_chunks()
            offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(part) + 1]
            raw = np.frombuffer(spaced.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            data = np.empty(len(raw) + 1, np.uint8)
            data[0] = 32
            data[1:] = raw
            yield batch.slice(lo, hi - lo), data, offsets - offsets[0] + 1
            lo = hi


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block."""
    blank = BLANK[data]
    change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    return change[0::2], change[1::2]  # a block begins and ends with a space


def prefix(data: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
    """Running polynomial sums, from which any stretch's hash follows; ``values``: a number for each byte."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values[data] * powers_to(BASE, len(data)), out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``; equal bytes have equal hashes."""
    back = powers_to(BASE_INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def per_text(values: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` by the text that holds position ``at`` (ascending)."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    edge = np.searchsorted(at, offsets)
    return sums[edge[1:]] - sums[edge[:-1]]


def table(rows: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    """The rows' own ``keep`` columns and new ones."""
    arrays = [rows.column(c) for c in keep] + [v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *columns])
