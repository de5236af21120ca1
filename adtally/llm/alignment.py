"""Token groups of two tokenizers over the same texts, from fragments that compose.

Where a token of A and a token of B both end, a text is cut; what lies between
two cuts is a group. A *fragment* stands for the tokens that end in some byte
range: its first segment goes up to the first cut and is open to the left, its
last one begins after the last cut and is open to the right, those between are
closed groups. A range without a cut is one segment, open to both sides.
Composing two neighbours joins the last segment of one with the first of the
other, which is associative, and the fragment of no tokens changes nothing. So
the fragments of a text may be composed in any tree.

A text is read in units: a cut before a single blank between two other
characters that are no white space is one for both tokenizers, whatever stands
around it, so units can be encoded by themselves and remembered. The fragment
of a unit is closed at both sides.

A text of more than ``Sizes.long`` bytes is dealt out: pieces of it are encoded
in different tasks, each gives a fragment for every ``Sizes.range`` bytes, and
rounds of grouping compose ``Sizes.fan`` neighbours at a time. What a round closes leaves the
tree at once; only open ends go on.

Counts of id pairs: tasks collect texts into blocks, number the distinct pairs
of a block, and keep for each text the numbers of its pairs. Only the distinct
pairs of a block are shuffled to be counted and come back to their block.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adtally.llm.text import slices, whole
from adtally.session import stage

#: Links that are spelled out at a time.
LINKS = 2**20
_UNIT_BYTES = 320
_SPACE = r"[\s᠎]"
_ELSE = r"[^\s᠎]"
_CUT = re.compile(f"(?<={_ELSE}) (?={_ELSE})")
_UNSAFE = re.compile(rf" {_SPACE}|{_SPACE} |\A | \Z")


class Sizes(NamedTuple):
    """None of them changes a result."""

    #: Bytes of a text that is dealt out, and of the ranges that give its first fragments.
    long: int = 64 * 1024
    range: int = 16 * 1024
    #: Fragments that are composed at a time.
    fan: int = 16
    #: A block ends with the slice in which it reaches so many distinct pairs or numbers of pairs.
    pairs: int = 400_000
    slots: int = 2_000_000
    #: Bytes of text that are measured at a time.
    slice: int = 2**20
    #: Bytes that remembered units take, by estimate.
    remembered: int = 96 * 2**20


class Fragment(NamedTuple):
    """Tokens of A and B, and how many of each are in each segment."""

    a: np.ndarray
    b: np.ndarray
    of_a: np.ndarray
    of_b: np.ndarray

    @property
    def cut(self) -> bool:
        return len(self.of_a) > 1

    def part(self, first: int, last: int) -> Fragment:
        """Some of the segments."""
        x, y = np.concatenate([[0], np.cumsum(self.of_a)]), np.concatenate([[0], np.cumsum(self.of_b)])
        return Fragment(self.a[x[first]:x[last]], self.b[y[first]:y[last]], self.of_a[first:last], self.of_b[first:last])


def _numbers(values=()) -> np.ndarray:
    return np.array(values, np.int64)


NOTHING = Fragment(_numbers(), _numbers(), _numbers([0]), _numbers([0]))


def compose(f: Fragment, g: Fragment) -> Fragment:
    def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([x[:-1], [x[-1] + y[0]], y[1:]]).astype(np.int64)

    return Fragment(np.concatenate([f.a, g.a]), np.concatenate([f.b, g.b]), joined(f.of_a, g.of_a), joined(f.of_b, g.of_b))


def fragment(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of tokens with their end offsets."""
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    x = np.concatenate([[0], np.searchsorted(a_ends, cuts, "right"), [len(a)]])
    y = np.concatenate([[0], np.searchsorted(b_ends, cuts, "right"), [len(b)]])
    return Fragment(a, b, np.diff(x), np.diff(y))


def _places(f: Fragment) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens of A and of B come when closed segments are written one after the other."""
    before_b = np.cumsum(f.of_b) - f.of_b
    upto_a = np.cumsum(f.of_a)
    return (np.arange(len(f.a)) + np.repeat(before_b, f.of_a), np.arange(len(f.b)) + np.repeat(upto_a, f.of_b))


@functools.cache
def _decimal(width: int) -> list[str]:
    return [f"{i}{mark}" for i in range(width) for mark in _MARKS]


_MARKS = [",", "|", ";"]


def _written(f: Fragment) -> list[str]:
    """Every id of the closed segments with the mark behind it."""
    at_a, at_b = _places(f)
    code = np.zeros(len(f.a) + len(f.b), np.int64)
    code[at_a], code[at_b] = 3 * f.a, 3 * f.b
    code[at_a[np.cumsum(f.of_a) - 1]] += 1
    code[at_b[np.cumsum(f.of_b) - 1]] += 2
    # Vocabularies are rounded up, so that few tables are made.
    table = _decimal(1 << (int(code.max(initial=0)) // 3).bit_length())
    return [table[c] for c in code.tolist()]


def spelled(f: Fragment) -> str:
    """Closed segments as text."""
    return "".join(_written(f))[:-1]


def links(f: Fragment, width: int, plus: np.ndarray | int = 0) -> Iterator[np.ndarray]:
    """The pairs of closed segments as a * width + b, at most about ``LINKS`` at a time.

    ``plus`` is added to the pairs of each token of A.
    """
    left = f.a * width + plus
    begin = np.cumsum(f.of_b) - f.of_b
    partners = np.repeat(f.of_b, f.of_a)
    begin = np.repeat(begin, f.of_a)
    upto = np.cumsum(partners)
    first = 0
    while first < len(f.a):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + LINKS, "right")))
        n = partners[first:last]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[first:last], n)
        yield np.repeat(left[first:last], n) + f.b[place]
        first = last


def distinct_links(f: Fragment, width: int, plus: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and how often each is there."""
    found = [np.unique(some, return_counts=True) for some in links(f, width, plus)]
    while len(found) > 1:
        found = [_summed(*map(np.concatenate, zip(*found[i:i + 8]))) for i in range(0, len(found), 8)]
    return found[0] if found else (_numbers(), _numbers())


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else _numbers()
    return keys[new], np.add.reduceat(times, new) if len(new) else times


class Pair:
    """Two tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # The byte-level alphabet: visible bytes stand for themselves, the others for 256 and up in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.width = len(self.b_bytes)
        #: Above every pair of ids.
        self.space = len(self.a_bytes) * self.width

    def encode(self, units: list[str]) -> Encoded:
        """Tokens of units, each of which begins with a blank."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] for u in units], num_threads=1)
        data = [u.encode() for u in units]
        size = _numbers([len(d) for d in data])
        same = np.ones(len(units), bool)
        sides = []
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            flat = [i for row in ids for i in row]
            parts = [table[i] for i in flat]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            sides.append((_numbers(flat), lengths, counts))
            got = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
            if not np.array_equal(np.diff(got), size) or b"".join(parts) != b"".join(data):
                at = 0
                for k, (row, wanted) in enumerate(zip(ids, data)):
                    same[k] &= b"".join(parts[at:at + len(row)]) == wanted
                    at += len(row)
        return Encoded(*[v for side in sides for v in side], size, same)


class Encoded(NamedTuple):
    """Tokens of some units: ids, their bytes, and how many a unit has."""

    a: np.ndarray
    a_bytes: np.ndarray
    a_count: np.ndarray
    b: np.ndarray
    b_bytes: np.ndarray
    b_count: np.ndarray
    #: Bytes of each unit, and whether the tokens spell these.
    size: np.ndarray
    same: np.ndarray

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_bytes), np.cumsum(self.b_bytes)

    def good(self) -> Encoded:
        """Without the tokens and bytes of units whose bytes differ."""
        if self.same.all():
            return self
        in_a, in_b = np.repeat(self.same, self.a_count), np.repeat(self.same, self.b_count)
        return Encoded(self.a[in_a], self.a_bytes[in_a], self.a_count * self.same, self.b[in_b], self.b_bytes[in_b],
                       self.b_count * self.same, self.size * self.same, self.same)


@functools.cache
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def units(text: str) -> list[str]:
    """The text behind a blank, cut into units that each begin with a blank."""
    return [" " + u for u in (_CUT.split(text) if _UNSAFE.search(text) else text.split(" "))]


class _Ragged:
    """Rows of numbers behind one another."""

    def __init__(self) -> None:
        self._flat = _numbers()
        self._begin = _numbers([0])

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self._flat = np.concatenate([self._flat, values])
        self._begin = np.concatenate([self._begin, self._begin[-1] + np.cumsum(sizes)])

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self._begin[rows + 1] - self._begin[rows]

    def of(self, rows: np.ndarray) -> np.ndarray:
        size = self.sizes(rows)
        return self._flat[np.arange(size.sum()) + np.repeat(self._begin[rows] - np.cumsum(size) + size, size)]


class Units(dict):
    """Numbers of units, and what is known of each by number."""

    def __init__(self, both: Pair) -> None:
        self.both = both
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.held = 0
        self.keys_, self.times = _Ragged(), _Ragged()
        #: Tokens of A and of B, groups and links of each unit; no groups where bytes differ.
        self.shape = np.zeros((0, 4), np.int64)
        self.groups: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.fresh.append(unit)
        self.held += _UNIT_BYTES + 5 * len(unit)
        return number

    def learn(self) -> None:
        """Encode and align the units that are new, all at once."""
        n = len(self.fresh)
        if not n:
            return
        found = self.both.encode(self.fresh).good()
        self.fresh = []
        ends = found.ends()
        f = fragment(found.a, found.b, *ends)
        f = f.part(0, len(f.of_a) - 1)  # nothing is open behind a unit
        # Units end with a group each.
        last = np.searchsorted(np.cumsum(f.of_a), np.cumsum(found.a_count), "right")
        groups = np.diff(last, prepend=0)
        marked, at = _written(f), np.concatenate([[0], np.cumsum(found.a_count + found.b_count)]).tolist()
        self.groups += ["".join(marked[x:y])[:-1] for x, y in zip(at, at[1:])]
        unit_of = np.repeat(np.arange(n), found.a_count)
        space = self.both.space
        keys, times = distinct_links(f, self.both.width, unit_of * space)
        sizes = np.bincount(keys // space, minlength=n)
        self.keys_.add(keys % space, sizes)
        self.times.add(times, sizes)
        total = np.bincount(keys // space, times, n).astype(np.int64)
        self.shape = np.concatenate([self.shape, np.stack([found.a_count, found.b_count, groups, total], axis=1)])


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers."""
    ends = np.concatenate([[0], np.cumsum(4 * lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths),
                                 [None, pa.py_buffer(ends), pa.py_buffer(data.astype(np.uint32).tobytes())])


#: A text or a part of one (``row``, ``place``) with the numbers of its pairs, or the pairs of a block.
_MEASURED = pa.schema([
    ("block", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
    ("slots", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64()))])
_MEASURED_DDL = ("block bigint, row bigint, place bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
                 "n_links bigint, groups string, slots binary, times binary, pairs array<bigint>, holders array<bigint>")


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _MEASURED],
        schema=_MEASURED)


class _Block:
    """Texts of one task whose pairs are numbered together."""

    def __init__(self, number: int, sizes: Sizes) -> None:
        self.number, self.sizes = number, sizes
        self.rows: list[tuple[dict, np.ndarray, np.ndarray, np.ndarray]] = []
        self.seen = _numbers()
        self.slots = 0

    def add(self, columns: dict, keys: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> None:
        self.rows.append((columns, keys, times, lengths))
        self.seen = np.union1d(self.seen, keys)
        self.slots += len(keys)

    @property
    def full(self) -> bool:
        return len(self.seen) >= self.sizes.pairs or self.slots >= self.sizes.slots

    def out(self) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(len(self.seen), np.int64)
        for columns, keys, times, lengths in self.rows:
            slots = np.searchsorted(self.seen, keys)
            holders += np.bincount(slots, minlength=len(self.seen))
            n = len(lengths)
            yield _batch(n, block=np.full(n, self.number), slots=_binary(slots, lengths), times=_binary(times, lengths), **columns)
        for first in range(0, len(self.seen), 65_536):
            some = slice(first, first + 65_536)
            yield _batch(1, block=[self.number], pairs=[self.seen[some]], holders=[holders[some]])


def _task() -> int:
    return TaskContext.get().partitionId() << 32


def _measure_texts(paths: tuple[str, str], sizes: Sizes, spell: bool):
    """Whole texts into rows of ``_MEASURED``. ``groups``: their SHA-256, or with ``spell`` the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units(pair(*paths))
        block = _Block(_task(), sizes)
        for b in slices(batches, "text", sizes.slice):
            if known.held > sizes.remembered:
                known.forget()
            number, count = [], np.zeros(b.num_rows, np.int64)
            for i, value in enumerate(b.column("text")):
                text = value.as_buffer().to_pybytes().decode("utf-8", "replace")
                if text:
                    codes = [known[u] for u in units(text)]
                    count[i] = len(codes)
                    number += codes
            known.learn()
            number = _numbers(number)
            text_of = np.repeat(np.arange(b.num_rows), count)
            bad = np.zeros(b.num_rows, bool)
            bad[text_of[known.shape[number, 2] == 0]] = True
            number, text_of = number[~bad[text_of]], text_of[~bad[text_of]]
            count[bad] = 0
            shape = np.zeros((b.num_rows, 4), np.int64)
            if len(number):
                begin = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))
                shape[text_of[begin]] = np.add.reduceat(known.shape[number], begin)
            columns = {"doc_id": b.column("doc_id"), **dict(zip(("n_a", "n_b", "n_groups", "n_links"), shape.T))}
            upto, groups = np.concatenate([[0], np.cumsum(count)]).tolist(), []
            spelt = [known.groups[i] for i in number.tolist()]
            for first, last in zip(upto, upto[1:]):
                text = ";".join(spelt[first:last])
                groups.append(text if spell or not text else hashlib.sha256(text.encode()).hexdigest())
            # Distinct units of each text first, then the distinct pairs of these.
            both, often = _summed(text_of * len(known) + number, np.ones(len(number), np.int64))
            unit = both % max(1, len(known))
            size = known.keys_.sizes(unit)
            space = known.both.space
            keys = np.repeat(both // max(1, len(known)), size) * space + known.keys_.of(unit)
            keys, times = _summed(keys, known.times.of(unit) * np.repeat(often, size))
            lengths = np.bincount(keys // space, minlength=b.num_rows)
            block.add({**columns, "groups": groups}, keys % space, times, lengths)
            if block.full:
                yield from block.out()
                block = _Block(block.number + 1, sizes)
        yield from block.out()

    return run


# ---------------------------------------------------------------- long texts

_PIECE_DDL = "row bigint, doc_id bigint, start bigint, text binary"


def _pieces(sizes: Sizes):
    """Long texts cut between units, a piece of about ``sizes.long`` bytes in each row; ``start`` counts bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = _task()
        for b in batches:
            for doc_id, value in zip(b.column("doc_id"), b.column("text"), strict=True):
                text = value.as_buffer().to_pybytes().decode("utf-8", "replace")
                start, at = 0, 0
                while at < len(text):
                    cut = _CUT.search(text, min(len(text), at + sizes.long // 2))
                    end = cut.start() if cut else len(text)
                    data = text[at:end].encode()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([doc_id.as_py()], pa.int64()),
                         pa.array([start], pa.int64()), pa.array([data], pa.binary())], ["row", "doc_id", "start", "text"])
                    start += len(data) + 1
                    at = end + 1  # the blank is put before every unit again
                row += 1

    return run


_OPEN = ["a", "b", "of_a", "of_b"]
#: Fragments of byte ranges: in ``open`` only the two outer segments, closed ones in between have left.
_FRAGMENT = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("kind", pa.string()),
    *[(c, pa.list_(pa.int64())) for c in _OPEN], ("since", pa.int64())])
_FRAGMENT_DDL = ("row bigint, doc_id bigint, start bigint, kind string, a array<bigint>, b array<bigint>, "
                 "of_a array<bigint>, of_b array<bigint>, since bigint")


def _out(row: int, doc_id: int | None, start: int, kind: str, f: Fragment, since: int | None = None) -> tuple:
    return (row, doc_id, start, kind, *[v.tolist() for v in f], since)


def _rows_out(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_FRAGMENT), _FRAGMENT)], schema=_FRAGMENT)


def _released(row: int, doc_id: int | None, start: int, f: Fragment, since: int) -> Iterator[tuple]:
    """The closed segments of a fragment, and what is left of it."""
    if not f.cut:
        yield _out(row, doc_id, start, "open", f)
        return
    last = len(f.of_a) - 1
    if last > 1:
        yield _out(row, doc_id, 2 * start, "closed", f.part(1, last))
    head, tail = f.part(0, 1), f.part(last, last + 1)
    yield _out(row, doc_id, start, "open", Fragment(*[np.concatenate(v) for v in zip(head, tail)]), since)


def _leaves(paths: tuple[str, str], size: int):
    """Pieces into fragments of ``size`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*paths)
        for b in batches:
            for r in range(b.num_rows):
                row, doc_id, start = (b.column(c)[r].as_py() for c in ("row", "doc_id", "start"))
                text = b.column("text")[r].as_buffer().to_pybytes().decode("utf-8", "replace")
                found = both.encode(units(text))
                if not found.same.all():
                    yield from _rows_out([_out(row, doc_id, start, "differs", NOTHING)]).to_batches()
                    continue
                a_ends, b_ends = (e + start for e in found.ends())
                at = int(a_ends[-1])
                rows = []
                for low in range(start // size * size, at, size):  # tokens that end in the range
                    x, y = (np.searchsorted(e, [low + 1, low + size + 1]) for e in (a_ends, b_ends))
                    f = fragment(found.a[slice(*x)], found.b[slice(*y)], a_ends[slice(*x)], b_ends[slice(*y)])
                    rows += _released(row, doc_id, max(low, start), f, max(low, start))
                yield from _rows_out(rows).to_batches()

    return run


def _fragment_of(table: pa.Table, i: int) -> Fragment:
    return Fragment(*[_numbers(table.column(c)[i].as_py()) for c in _OPEN])


def _composed(group: pa.Table) -> pa.Table:
    """One fragment for all of a group, and what closes between its members."""
    group = group.sort_by("start")
    row, doc_id, first = (group.column(c)[0].as_py() for c in ("row", "doc_id", "start"))
    total, since, closed = NOTHING, None, []
    for i in range(group.num_rows):
        total = compose(total, _fragment_of(group, i))
        while len(total.of_a) > 2:  # the segment after the first cut has closed
            closed.append(_out(row, doc_id, 2 * since + 1, "closed", total.part(1, 2)))
            head, tail = total.part(0, 1), total.part(2, len(total.of_a))
            total = Fragment(*[np.concatenate(v) for v in zip(head, tail)])
        if group.column("since")[i].is_valid:
            since = group.column("since")[i].as_py()
    return _rows_out([*closed, _out(row, doc_id, first, "open", total, since)])


def _long_groups(docs: DataFrame, paths: tuple[str, str], sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """Closed fragments (row, doc_id, start, ...) of long texts, and (row, doc_id) of those whose bytes differ."""
    spark = docs.sparkSession
    pieces = stage(spark, docs.mapInArrow(_pieces(sizes), _PIECE_DDL), "pieces")
    longest = pieces.agg(F.max("start")).first()[0] or 0
    found = stage(spark, pieces.repartition("row", "start").mapInArrow(
        _leaves(paths, sizes.range), _FRAGMENT_DDL), "fragments")
    differs = found.where("kind = 'differs'").select("row", "doc_id").distinct()
    found = found.join(differs.select("row"), "row", "left_anti")
    closed, span = found.where("kind = 'closed'"), sizes.range
    rest = found.where("kind = 'open'")
    while True:
        span *= sizes.fan
        level = stage(spark, rest.groupBy("row", F.floor(F.col("start") / span).alias("range")).applyInArrow(
            _composed, _FRAGMENT_DDL), "fragments")
        closed = closed.unionByName(level.where("kind = 'closed'"))
        rest = level.where("kind = 'open'")
        if span > longest:
            break
    # A text begins and ends with a cut: its first segment is a group, behind its last cut there is nothing.
    first = rest.where(F.size("of_a") > 1).select(
        "row", "doc_id", F.lit(-1).cast("bigint").alias("start"), "kind",
        *[F.slice(c, 1, F.element_at("of_a" if c == "a" else "of_b", 1).cast("int")).alias(c) for c in ("a", "b")],
        *[F.slice(c, 1, 1).alias(c) for c in ("of_a", "of_b")], "since")
    return closed.unionByName(first), differs


def _measure_parts(paths: tuple[str, str]):
    """Closed fragments into rows of ``_MEASURED``; each is a block by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = pair(*paths), -1 - _task()
        for b in batches:
            for i in range(b.num_rows):
                f = _fragment_of(b, i)
                keys, times = distinct_links(f, both.width)
                n = _numbers([len(keys)])
                yield _batch(
                    1, block=[number], row=[b.column("row")[i].as_py()], place=[b.column("start")[i].as_py()],
                    doc_id=[b.column("doc_id")[i].as_py()], n_a=[len(f.a)], n_b=[len(f.b)], n_groups=[len(f.of_a)],
                    n_links=[times.sum()], groups=[spelled(f)], slots=_binary(np.arange(len(keys)), n),
                    times=_binary(times, n), pairs=[keys], holders=[np.ones(len(keys), np.int64)])
                number -= 1

    return run


# -------------------------------------------------------------------- counts

_COUNTED = ["row", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
_COUNTED_DDL = ("row bigint, place bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "groups string, n_best bigint, count_sum bigint")


def _looked_up(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of each text of a block, from the counts of the block's pairs."""
    order = np.argsort(pairs.column("pair").to_numpy()) if pairs.num_rows else _numbers()
    count = pairs.column("n").to_numpy()[order] if pairs.num_rows else _numbers()
    best = pairs.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order] if pairs.num_rows else _numbers()
    n_best, total = [], []
    for slots, times in zip(texts.column("slots"), texts.column("times"), strict=True):
        slot = np.frombuffer(slots.as_buffer(), np.uint32)
        often = np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
        n_best.append(int(often @ best[slot]))
        total.append(int(often @ count[slot]))
    return texts.select(_COUNTED).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
        "count_sum", pa.array(total, pa.int64()))


def _counted(measured: DataFrame, width: int) -> DataFrame:
    listed = measured.where("pairs is not null").select(
        "block", "row", F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select(
        "block", "row", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    # A long text has several blocks and counts once.
    of_long = listed.where("row is not null").select("row", "pair").distinct().select("pair", F.lit(1).cast("bigint").alias("holders"))
    counts = listed.where("row is null").select("pair", "holders").union(of_long).groupBy("pair").agg(
        F.sum("holders").alias("n"))
    counts = stage(measured.sparkSession, counts, "pair-counts").withColumn("of", F.floor(F.col("pair") / width))
    most = counts.groupBy("of").agg(F.max("n").alias("most"))
    # A row for each id of A, so bounded by the vocabulary.
    counts = counts.join(F.broadcast(most), "of").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    looked = listed.select(F.col("block").alias("of_block"), "pair").join(counts, "pair")
    texts = measured.where("doc_id is not null or n_a is not null").select("block", *_COUNTED, "slots", "times")
    return texts.groupBy("block").cogroup(looked.groupBy("of_block")).applyInArrow(_looked_up, _COUNTED_DDL)


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_RESULT_DDL = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in _SUMS], "groups_sha256 string"])


def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of long texts, sorted by row and place, into a row for each text."""
    names = ["doc_id", *_SUMS, "groups_sha256"]

    def out(doc_id, sums, digest):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in (doc_id, *sums)] + [pa.array([digest.hexdigest()])], names)

    row = None
    for b in batches:
        for r in b.to_pylist():
            if r["row"] != row:
                if row is not None:
                    yield out(doc_id, sums, digest)
                row, doc_id, sums, digest = r["row"], r["doc_id"], [0] * len(_SUMS), hashlib.sha256()
            else:
                digest.update(b";")
            digest.update(r["groups"].encode())
            sums = [x + r[c] for x, c in zip(sums, _SUMS)]
    if row is not None:
        yield out(doc_id, sums, digest)


def _split(docs: DataFrame, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text"))
    long = F.octet_length("text") > sizes.long
    return docs.where(~long), docs.where(long)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, sizes: Sizes = Sizes()) -> DataFrame:
    """A row for every row of ``docs`` (doc_id, text): how its tokens by A and B line up.

    A (a byte-level tokenizers file) encodes a blank and the text, B (a
    sentencepiece model, which adds the blank) the text. Columns: doc_id, n_a,
    n_b, n_groups; n_links, the pairs of an A and a B token in one group;
    count_sum, over them the number of rows of ``docs`` that hold the pair of
    ids; n_best, how many of them have the highest such number of their A id;
    groups_sha256 of ``token_groups`` put together.

    A null or empty text, or one whose tokens spell other bytes, has zeros and
    ''. Repeated rows are texts of their own, null ids pass through, an empty
    table gives an empty result, other columns are ignored.
    """
    spark, paths = docs.sparkSession, (a_path, b_path)
    short, long = _split(docs, sizes)
    closed, differs = _long_groups(long, paths, sizes)
    measured = short.mapInArrow(_measure_texts(paths, sizes, spell=False), _MEASURED_DDL).unionByName(
        closed.mapInArrow(_measure_parts(paths), _MEASURED_DDL))
    counted = stage(spark, _counted(stage(spark, measured, "measured"), pair(*paths).width), "counted")
    of_short = counted.where("row is null").select("doc_id", *_SUMS, F.col("groups").alias("groups_sha256"))
    of_long = counted.where("row is not null").repartition("row").sortWithinPartitions("row", "place").mapInArrow(
        _whole_texts, _RESULT_DDL)
    other = differs.select("doc_id", *[F.lit(0).cast("bigint").alias(c) for c in _SUMS], F.lit("").alias("groups_sha256"))
    return of_short.unionByName(of_long).unionByName(other).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def token_groups(docs: DataFrame, a_path: str, b_path: str, sizes: Sizes = Sizes()) -> DataFrame:
    """(doc_id, row, place, groups): the groups of every text as ``a1,a2|b1;a3|b2,b3``.

    A long text has a row for each of its parts, which share ``row`` and are in
    order by ``place``; other texts have one row without them. Texts without
    tokens have ''; of long ones whose bytes differ there is no row.
    """
    paths = (a_path, b_path)
    short, long = _split(docs, sizes)
    closed, _ = _long_groups(long, paths, sizes)
    rows = short.mapInArrow(_measure_texts(paths, sizes, spell=True), _MEASURED_DDL).where("n_a is not null").unionByName(
        closed.mapInArrow(_measure_parts(paths), _MEASURED_DDL))
    return rows.select("doc_id", "row", "place", "groups")
