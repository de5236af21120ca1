"""Byte-level BPE encoding and decoding in two tiers.

A pattern splits a text into pre-tokens. A minimal perfect hash (hash and
displace, Belazzougui et al., 2009) gives every vocabulary entry a slot of its
own, so a whole pre-token is looked up with one displacement and one
comparison. Pre-tokens that are no entry are merged: bytes form a linked list,
and a heap yields the adjacent pair of the lowest rank, the leftmost first.

The vocabulary is a file of ranks: base64 of the bytes, a space, the rank.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.text import U64, hashes, mix, slices, whole

#: Pre-tokens whose ids a worker remembers at a time.
REMEMBERED = 600_000
_STEP = U64(0x9E3779B97F4A7C15)
_LOW, _NEXT = 2**32 - 1, 2**32 + 1


class PerfectHash:
    """Slots 0 .. n-1 for n distinct 64-bit keys, one each."""

    def __init__(self, keys: np.ndarray):
        self.n, self.groups = len(keys), len(keys) // 3 + 1
        self.shift = np.zeros(self.groups, np.int64)
        group = self._group(keys)
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=self.groups)
        first = np.cumsum(sizes) - sizes
        free = np.ones(self.n, bool)
        for g in np.argsort(-sizes, kind="stable").tolist():
            if sizes[g] < 2:
                break
            own = keys[order[first[g]:first[g] + sizes[g]]]
            tried = 1
            while True:
                tries = np.arange(tried, tried + 32, dtype=np.int64)
                slots = np.sort(self._slot(own[None, :], tries[:, None]), axis=1)
                fits = free[slots].all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                if fits.any():
                    at = int(np.argmax(fits))
                    self.shift[g] = tries[at]
                    free[slots[at]] = False
                    break
                tried += 32
        # A group of one takes any slot that is left; its number is stored below zero.
        single = np.flatnonzero(sizes == 1)
        self.shift[single] = -1 - np.flatnonzero(free)[:len(single)]

    def _group(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) % U64(self.groups)).astype(np.int64)

    def _slot(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + shift.astype(U64) * _STEP) % U64(self.n)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        shift = self.shift[self._group(keys)]
        return np.where(shift < 0, -1 - shift, self._slot(keys, shift))


def keys_of(pieces: list[bytes]) -> np.ndarray:
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    return hashes(np.frombuffer(b"".join(pieces), np.uint8), ends - lengths, ends)


class Vocabulary:
    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    piece, rank = line.split()
                    self.ranks[base64.b64decode(piece)] = int(rank)
        pieces = list(self.ranks)
        #: Ids as four bytes, ranks above the places of a heap entry, and the latter by pairs of bytes.
        self.code = {p: r.to_bytes(4, "little") for p, r in self.ranks.items()}
        self.high_rank = {p: r << 64 for p, r in self.ranks.items()}
        self.pairs = [self.high_rank.get(bytes((i >> 8, i & 255))) for i in range(65536)]
        by_id = dict(zip(self.ranks.values(), pieces, strict=True))
        every = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.length = np.array([len(p) for p in every])
        self.begin = np.cumsum(self.length) - self.length
        self.all_bytes = np.frombuffer(b"".join(every), np.uint8)
        keys = keys_of(pieces)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two entries have one hash")
        self.table = PerfectHash(keys)
        self.at: list[bytes] = [b""] * len(pieces)
        for slot, piece in zip(self.table.slots(keys).tolist(), pieces, strict=True):
            self.at[slot] = piece
        self.code_at = [self.code[p] for p in self.at]

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, four bytes each."""
        out = []
        for piece, slot in zip(pieces, self.table.slots(keys_of(pieces)).tolist(), strict=True):
            out.append(self.code_at[slot] if self.at[slot] == piece else self.merge(piece))
        return out

    def merge(self, piece: bytes) -> bytes:
        """Ids of a pre-token: bytes in a linked list, pairs in a heap by rank and then by place.

        A heap entry is one number: rank, place of the pair, place after it.
        ``after`` is 0 for a symbol that went into the one before it.
        """
        n, get, pairs = len(piece), self.high_rank.get, self.pairs
        after, before = [*range(1, n + 1), 0], list(range(-1, n))
        heap, place, last = [], 2, piece[0]
        for byte in piece[1:]:
            if (r := pairs[last << 8 | byte]) is not None:
                heap.append(r | place)
            place += _NEXT
            last = byte
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, end = entry >> 32 & _LOW, entry & _LOW
            right = after[i]
            if not right or after[right] != end:
                continue  # one of the two has grown meanwhile
            after[right] = 0
            after[i] = end
            if end < n:
                before[end] = i
                if (r := get(piece[i:after[end]])) is not None:
                    heappush(heap, r | i << 32 | after[end])
            if (left := before[i]) >= 0 and (r := get(piece[left:end])) is not None:
                heappush(heap, r | left << 32 | end)
        out, i = [], 0
        while i < n:
            out.append(self.code[piece[i:after[i]]])
            i = after[i]
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, copied from one table in one step."""
        length = self.length[ids]
        end = np.cumsum(length)
        if not len(end):
            return b""
        at = np.arange(end[-1]) + np.repeat(self.begin[ids] - (end - length), length)
        return self.all_bytes[at].tobytes()


_LOADED: dict[str, Vocabulary] = {}
#: Ids of pre-tokens as little-endian 32-bit numbers, kept from task to task of a worker.
_IDS_OF: dict[str, dict[str, bytes]] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _codec(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, find = vocabulary(path), regex.compile(pattern).findall
        ids_of = _IDS_OF.setdefault(path, {})
        for b in slices(batches, "text"):
            cut = [find(v.as_buffer().to_pybytes().decode("utf-8", "replace")) for v in b.column("text")]
            if len(ids_of) > REMEMBERED:
                ids_of.clear()
            new = list(set().union(*cut).difference(ids_of))
            if new:
                ids_of.update(zip(new, known.encode([p.encode() for p in new]), strict=True))
            ids = [b"".join(map(ids_of.__getitem__, own)) for own in cut]
            decoded = [known.decode(np.frombuffer(i, "<u4")) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(decoded, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, path: str, pattern: str, text: str | Column = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit numbers, ``decoded`` the bytes
    they stand for. ``path`` must lead to the rank file on every executor. A
    null or empty text has no ids. Bytes that are no UTF-8 become U+FFFD first,
    as any library on text would have it. Strings of special tokens are
    ordinary text. Rows are independent, so repeated rows and null ids pass
    through; an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(text).alias("text")).mapInArrow(
        _codec(path, pattern), "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
