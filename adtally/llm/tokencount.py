"""Token counts of a sentence-piece BPE model by rank-synchronous array merging.

Pieces of the model hold the space mark only at their beginning, so no merge
crosses from a word into the space mark after it: a text falls apart into
pre-tokens. Many pre-tokens are held as one ragged array of symbol numbers. In
each round every sequence looks up the ranks of its adjacent pairs and merges
all places of its lowest pair, from the left where they overlap, until none is
left. What remains is counted; a character without a piece counts as its
UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.text import slices, whole

MARK = "▁"
#: Pre-tokens that are remembered, and their characters at most.
REMEMBERED, LONGEST = 600_000, 64
#: Symbols of a sequence that is merged by itself.
LONG = 400
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6
_NONE = np.int64(2**62)
_GONE = -2


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + size]
            at += size


class Model:
    """Merge ranks of a model file with byte fallback and without text normalisation."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        pieces: list[tuple[str, float]] = []
        fixed: list[str] = []
        fallback = False
        for field, body in message:
            if field == 1:
                piece = dict(_fields(body))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                if kind in (NORMAL, USER_DEFINED, UNUSED):
                    pieces.append((text, struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]))
                if kind == USER_DEFINED:
                    fixed.append(text)
                if kind == UNUSED:
                    raise ValueError("unused pieces are not supported")
                fallback |= kind == BYTE
            elif field == 3:
                rules = dict(_fields(body))
                if rules.get(2) or rules.get(3, 1) != 1 or rules.get(4, 1) or rules.get(5, 1) != 1:
                    raise ValueError("only models without normalisation and with a dummy prefix are supported")
        if not fallback or any(MARK in p.lstrip(MARK) for p, _ in pieces):
            raise ValueError("only models with byte fallback and leading space marks are supported")
        ids: dict[str, int] = {}
        for text, _ in pieces:
            ids.setdefault(text, len(ids))
        #: Tokens that a symbol stands for.
        size = [1] * len(ids)
        for char in sorted({c for text, _ in pieces for c in text}):
            if char not in ids:
                ids[char] = len(ids)
                size.append(len(char.encode()))
        self.size = np.array(size, np.int64)
        #: Symbol of each character, below zero if no piece has it.
        self.symbol = np.full(0x110000, -1, np.int64)
        for char, i in ids.items():
            if len(char) == 1:
                self.symbol[ord(char)] = i
        self.n = len(ids)
        # Equal scores share a rank, as the leftmost of them comes first.
        score = {text: s for text, s in pieces}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        table = {}
        for text, s in score.items():
            for cut in range(1, len(text)):
                left, right = ids.get(text[:cut]), ids.get(text[cut:])
                if left is not None and right is not None:
                    table[left * self.n + right] = (rank[s], ids[text])
        self.pairs = np.array(sorted(table), np.int64)
        found = [table[k] for k in self.pairs.tolist()]
        self.rank = np.array([r for r, _ in found], np.int64)
        self.merged = np.array([m for _, m in found], np.int64)
        alone = "\n" if self.symbol[10] < 0 else ""
        known = sorted(map(re.escape, fixed), key=len, reverse=True)
        self.fixed = set(fixed)
        self.split = re.compile(
            "|".join([*known, *[re.escape(alone)] * bool(alone), f"{MARK}*[^{MARK}{alone}]+", f"{MARK}+"]))
        self.inside = re.compile("|".join(known)) if any(f.strip(MARK) for f in fixed) else None

    def pre_tokens(self, text: str) -> list[str]:
        if not text:
            return []
        return self.split.findall(MARK + text.replace(" ", MARK))

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), np.int64)
        if self.fixed:
            parts, owner = [], []
            for k, word in enumerate(words):
                for part in self._loose(word):
                    if part in self.fixed:
                        out[k] += 1
                    else:
                        parts.append(part)
                        owner.append(k)
            owner = np.array(owner, np.int64)
        else:
            parts, owner = words, np.arange(len(words))
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols, sequence = self.symbol[code], np.repeat(np.arange(len(parts)), length)
        strange = symbols < 0
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)  # bytes of a character
        out += np.bincount(owner[sequence[strange]], size[strange], len(out)).astype(np.int64)
        upto, short = np.cumsum(length), np.ones(len(symbols), bool)
        for part in np.flatnonzero(length > LONG).tolist():  # each by itself
            own = slice(upto[part] - length[part], upto[part])
            left = self._merged(symbols[own])
            out[owner[part]] += int(self.size[left[left >= 0]].sum())
            short[own] = False
        symbols, sequence = symbols[short], sequence[short]
        while len(symbols):
            ranks, merged = self._ranks(symbols, sequence)
            first = np.flatnonzero(np.diff(sequence, prepend=-1))
            lowest = np.minimum.reduceat(ranks, first)
            going = np.repeat(lowest < _NONE, np.diff(np.append(first, len(symbols))))
            done = ~going & (symbols >= 0)
            out += np.bincount(owner[sequence[done]], self.size[symbols[done]], len(out)).astype(np.int64)
            here = going & (ranks == np.repeat(lowest, np.diff(np.append(first, len(symbols)))))
            here = self._without_overlap(here)
            symbols = np.where(here, merged, symbols)
            keep = going & ~np.concatenate([[False], here[:-1]])
            symbols, sequence = symbols[keep], sequence[keep]
        return out

    def _merged(self, symbols: np.ndarray) -> np.ndarray:
        """What is left of one long sequence.

        Rank by rank as well, but the places of each rank are kept, and only
        the neighbours of a merged pair are looked up again: a round costs
        what it merges, not the length of the sequence.
        """
        n = len(symbols)
        symbols = symbols.copy()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank, merged = self._ranks(symbols, np.zeros(n, np.int64))
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < _NONE]
            order = places[np.argsort(rank[places], kind="stable")]
            ranks = rank[order]
            for some in np.split(order, np.flatnonzero(np.diff(ranks)) + 1) if len(order) else ():
                of = int(rank[some[0]])
                if of not in waiting:
                    waiting[of] = []
                    heapq.heappush(queue, of)
                waiting[of].append(some)

        wait(np.arange(n))
        while queue:
            lowest = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            apart = np.concatenate([[True], after[at[:-1]] != at[1:]])
            begin = np.flatnonzero(apart)[np.cumsum(apart) - 1]
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            gone = after[at]
            symbols[at], symbols[gone], rank[gone] = merged[at], _GONE, _NONE
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            near = np.unique(np.concatenate([at, before[at]]))
            near = near[near >= 0]
            rank[near] = _NONE
            near = near[after[near] < n]
            x, y = symbols[near], symbols[after[near]]
            near, x, y = (v[(x >= 0) & (y >= 0)] for v in (near, x, y))
            key = x * self.n + y
            found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[found] == key
            near, found = near[hit], found[hit]
            rank[near], merged[near] = self.rank[found], self.merged[found]
            wait(near)
        return symbols[symbols != _GONE]

    def _loose(self, word: str) -> list[str]:
        """The word cut at fixed pieces inside it."""
        if self.inside is None or word in self.fixed:
            return [word]
        parts, at = [], 0
        for m in self.inside.finditer(word):
            parts += [word[at:m.start()], m.group()]
            at = m.end()
        return [p for p in [*parts, word[at:]] if p]

    def _ranks(self, symbols: np.ndarray, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each symbol with the next of its sequence."""
        ranks, merged = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        joint = np.flatnonzero((sequence[1:] == sequence[:-1]) & (symbols[1:] >= 0) & (symbols[:-1] >= 0))
        key = symbols[joint] * self.n + symbols[joint + 1]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        ranks[joint[hit]], merged[joint[hit]] = self.rank[at[hit]], self.merged[at[hit]]
        return ranks, merged

    @staticmethod
    def _without_overlap(here: np.ndarray) -> np.ndarray:
        """Of places next to each other every other one, from the left."""
        at = np.flatnonzero(here)
        if not len(at):
            return here
        run = np.concatenate([[True], np.diff(at) != 1])
        begin = at[np.flatnonzero(run)[np.cumsum(run) - 1]]
        out = np.zeros(len(here), bool)
        out[at[(at - begin) % 2 == 0]] = True
        return out


_LOADED: dict[str, Model] = {}
#: Tokens of pre-tokens, kept from task to task of a worker.
_COUNT_OF: dict[str, dict[str, int]] = {}


def model(path: str) -> Model:
    if path not in _LOADED:
        _LOADED[path] = Model(path)
    return _LOADED[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count_of = model(path), _COUNT_OF.setdefault(path, {})
        for b in slices(batches, "text"):
            size, tokens = [], []
            texts = [v.as_buffer().to_pybytes() for v in b.column("text")]
            cut = [known.pre_tokens(t.decode("utf-8", "replace")) for t in texts]
            if len(count_of) > REMEMBERED:
                count_of.clear()
            new = list(set().union(*cut).difference(count_of))
            if new:
                count_of.update(zip(new, known.counts(new).tolist(), strict=True))
            for text, own in zip(texts, cut, strict=True):
                size.append(len(text))
                tokens.append(sum(map(count_of.__getitem__, own)))
            for word in new:
                if len(word) > LONGEST:
                    del count_of[word]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``.

    ``path`` must lead to the model file on every executor. A null or empty
    text has no bytes and no tokens. Strings of special tokens are ordinary
    text. Rows are independent: repeated rows and null ids pass through, an
    empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text")).mapInArrow(
        _count(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
