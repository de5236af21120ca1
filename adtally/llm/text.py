"""Words and shingles of many texts at once, as numpy arrays over Arrow buffers.

Texts arrive as Arrow binary columns without nulls. A word is a run of bytes
other than ASCII white space (``[^\\x20\\x09-\\x0D]+``); bytes of a multi-byte
character are never white space, so words never need decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 4 * 2**20
U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([0] + [(1 << (8 * n)) - 1 for n in range(1, 9)], U64)
_M1, _M2, _BASE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)


def whole(column: str | Column = "text") -> Column:
    """The bytes of a text; a null text is an empty one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    values = (values ^ (values >> U64(32))) * _M1
    values = (values ^ (values >> U64(29))) * _M2
    return values ^ (values >> U64(32))


def offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text is one by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = offsets(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


class Words(NamedTuple):
    """Words of some texts: their bytes, where each begins and ends, and the number of its text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    #: First word of each text, and one more entry.
    first: np.ndarray


def words(column: pa.Array, lower: bool) -> Words:
    at = offsets(column).astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[at[0]:at[-1]] if buffer is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # where no word goes on: white space on either side, or another text
    edge[at] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside])[:-1]))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside, [False]])[1:])) + 1
    first = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(column)), np.diff(first))
    return Words(data, starts, ends, text, first)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run, eight bytes at a time."""
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(9, np.uint8)]).tobytes(), 0, (1,))
    left = ends - starts
    out = mix(left.astype(U64) ^ (eight[starts] & _MASK[np.minimum(left, 8)]) * _BASE)
    live, at = np.flatnonzero(left > 8), 8
    while len(live):
        out[live] = mix(out[live] * _BASE ^ (eight[starts[live] + at] & _MASK[np.minimum(left[live] - at, 8)]))
        at += 8
        live = live[left[live] > at]
    return out


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values."""
    if len(values) < size:
        return np.zeros(0, U64)
    total = np.full(len(values) - size + 1, size, U64)
    for i in range(size):
        total = total * _BASE + values[i:len(values) - size + 1 + i]
    return mix(total)


class Shingles(NamedTuple):
    values: np.ndarray
    text: np.ndarray
    #: Number of the shingle's first word among all words.
    word: np.ndarray


def shingles(w: Words, values: np.ndarray, size: int) -> Shingles:
    """Every run of ``size`` words of one text; a text of fewer words is one shingle, one of none has none."""
    rolled = rolling(values, size)
    start = np.flatnonzero(w.text[:len(rolled)] == w.text[size - 1:]) if len(rolled) else np.zeros(0, np.int64)
    out, text = rolled[start], w.text[start]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        few = []
        for t in short:
            total = U64(int(count[t]) * 0x1F3)
            run = np.full(1, total, U64)
            for v in values[w.first[t]:w.first[t + 1]]:
                run = run * _BASE + v
            few.append(mix(run)[0])
        out, text = np.append(out, np.array(few, U64)), np.append(text, short)
        start = np.append(start, w.first[short])
        order = np.argsort(start, kind="stable")
        out, text, start = out[order], text[order], start[order]
    return Shingles(out, text, start)
