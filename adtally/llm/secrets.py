"""Secrets in texts and in what the texts encode.

A worklist holds layers. The first is the text itself. Each layer is scanned,
then unwrapped in every way that applies: percent escapes, Unicode escapes,
UTF-16, base64, compressed data. What comes out is a layer again, whatever its
bytes are, until nothing new appears; a digest of every layer seen ends cycles.
Each byte of a layer knows the span of the text it came from, so whatever is
found is reported there.

Base64 is read over line breaks and from each of four characters, as other
characters of its alphabet may stand in front. It is reported by whole runs:
all lines that hold a part of what was found.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from adtally.llm.text import slices, whole

#: Kinds in the order of reports; the first three are the base kinds.
PATTERNS: dict[str, tuple[re.Pattern[bytes], int, int]] = {
    # pattern, group that is measured, its least length
    "assign": (re.compile(
        rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}"), 0, 24),
    "hosting": (re.compile(rb"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]+"), 0, 40),
    "chat": (re.compile(rb"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]+"), 0, 15),
    "webtoken": (re.compile(rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"), 0, 20),
    "private": (re.compile(rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"), 0, 1),
}
KINDS = list(PATTERNS)
BASE = 3
_PERCENT = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_ALPHABET = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_STANDARD = bytes.maketrans(b"-_", b"+/")
_BREAK = re.compile(rb"[ \t]*(?:\r\n?|\n)[ \t]*")
#: ASCII in UTF-16 of either order, or in UTF-32. The shortest secret has 12 characters, of which the last may end the data.
_WIDE = re.compile(rb"(?:[\x01-\x7f]\x00{1,3}){11,}")
_HEADER = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Every secret, and everything that can be unwrapped to one, has one of these, ``_WIDE`` or ``_HEADER``.
_PLAIN = re.compile(rb"[\x20-\x7e\t\r\n]{12}")
#: Decompressed data is scanned in pieces of this size, each with the end of the one before. All that is found in it
#: is reported by the span of the compressed data, so it is enough that a part of a longer match is in a piece.
PIECE, OVERLAP = 4 * 2**20, 2**20
#: Bytes that an xz stream may ask for to be read.
XZ_MEMORY = 128 * 2**20


class Layer(NamedTuple):
    data: bytes
    #: Of each byte the span of the text in bytes; None in the first layer.
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.low is None:
            return start, end
        return int(self.low[start:end].min()), int(self.high[start:end].max())

    def inside(self, start: int, end: int, data: bytes) -> Layer:
        """A layer whose every byte came from one span of this one."""
        low, high = self.span(start, end)
        return Layer(data, np.full(len(data), low), np.full(len(data), high))


def _found(layer: Layer) -> Iterator[tuple[int, int, int]]:
    for kind, (pattern, group, least) in enumerate(PATTERNS.values()):
        for m in pattern.finditer(layer.data):
            if m.end(group) - m.start(group) >= least:
                yield kind, m.start(), m.end()


def _character(m: re.Match[bytes]) -> bytes | None:
    code = int(m[1] or m[2] or m[4], 16) if m[3] is None else int(m[3])
    return chr(code).encode() if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _replaced(layer: Layer, pattern: re.Pattern[bytes], decode) -> Layer | None:
    """The whole layer with every match decoded."""
    low = layer.low if layer.low is not None else np.arange(len(layer.data))
    high = layer.high if layer.high is not None else np.arange(1, len(layer.data) + 1)
    parts, lows, highs, at = [], [], [], 0
    for m in pattern.finditer(layer.data):
        out = decode(m)
        if out is None:
            continue
        parts += [layer.data[at:m.start()], out]
        lows += [low[at:m.start()], np.full(len(out), low[m.start():m.end()].min())]
        highs += [high[at:m.start()], np.full(len(out), high[m.start():m.end()].max())]
        at = m.end()
    if not parts:
        return None
    return Layer(b"".join([*parts, layer.data[at:]]), np.concatenate([*lows, low[at:]]),
                 np.concatenate([*highs, high[at:]]))


def _worth(data: bytes) -> bool:
    """Whether a secret can be in the data or in what they encode."""
    return bool(_PLAIN.search(data) or _HEADER.search(data) or (b"\0" in data and _WIDE.search(data)))


def _decompressor(data: bytes):
    if data[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if data[:2] in (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda"):
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=XZ_MEMORY)
    return None


def _stream(data: bytes) -> Iterator[bytes]:
    """Decompressed data in blocks, as far as it is sound."""
    try:
        if data[:4] == b"\x28\xb5\x2f\xfd":
            with zstandard.ZstdDecompressor().stream_reader(data) as reader:
                while block := reader.read(PIECE):
                    yield block
            return
        unpack = _decompressor(data)
        if unpack is None:
            return
        block = unpack.decompress(data, PIECE)
        while block:
            yield block
            if getattr(unpack, "eof", False):
                return
            block = unpack.decompress(getattr(unpack, "unconsumed_tail", b""), PIECE)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError, MemoryError):
        return


def _pieces(data: bytes) -> Iterator[bytes]:
    held, fresh = b"", 0
    for block in _stream(data):
        held += block
        fresh += len(block)
        if fresh >= PIECE:
            yield held
            held, fresh = held[-OVERLAP:], 0
    if fresh:
        yield held


def _joined(data: bytes) -> tuple[bytes, list[int], list[int]]:
    """The data without line breaks inside base64; where breaks were, and how many bytes went up to each."""
    parts, cuts, gone, at, total = [], [], [], 0, 0
    for m in _BREAK.finditer(data) if b"\n" in data or b"\r" in data else ():
        low, high = m.span()
        if low and high < len(data) and data[low - 1] in _ALPHABET and data[high] in _ALPHABET:
            parts.append(data[at:low])
            cuts.append(low - total)
            total += high - low
            gone.append(total)
            at = high
    return (b"".join([*parts, data[at:]]) if parts else data), cuts, gone


def _decoded(run: bytes) -> Iterator[tuple[int, bytes]]:
    """What base64 from each of the first four characters says, if that is of any use."""
    body = run.rstrip(b"=").translate(_STANDARD)
    for skip in range(4):
        part = body[skip:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        raw = binascii.a2b_base64(part + b"=" * (-len(part) % 4))
        if _worth(raw):
            yield skip, raw


def _base64(layer: Layer) -> Iterator[Layer]:
    data, cuts, gone = _joined(layer.data)
    for m in _BASE64.finditer(data):
        begin, end = m.span()
        first, last = bisect_right(cuts, begin), bisect_left(cuts, end)
        edges = [begin, *cuts[first:last], end]
        shifts = [gone[i - 1] if i else 0 for i in range(first, last + 1)]
        lines = [(low, high, low + by, high + by) for low, high, by in zip(edges, edges[1:], shifts)]
        if len(lines) == 1:
            for _, raw in _decoded(m[0]):
                yield layer.inside(*lines[0][2:], raw)
            continue
        spans = None
        for skip, raw in _decoded(m[0]):
            if spans is None:
                spans = np.repeat(np.array([layer.span(*line[2:]) for line in lines]), np.diff(edges), axis=0)
            byte = np.arange(len(raw))
            char = skip + byte // 3 * 4 + byte % 3  # of which the byte has its first bits
            yield Layer(raw, spans[char, 0], spans[char + 1, 1])
        for low, high, *span in lines:  # each may also be by itself
            if high - low >= 16:
                for _, raw in _decoded(data[low:high]):
                    yield layer.inside(*span, raw)


def _unwrapped(layer: Layer) -> Iterator[Layer]:
    if b"%" in layer.data and (out := _replaced(
            layer, _PERCENT, lambda m: binascii.unhexlify(m[0].replace(b"%", b"")))):
        yield out
    if (b"\\" in layer.data or b"&#" in layer.data) and (out := _replaced(layer, _UNICODE, _character)):
        yield out
    if b"\0" in layer.data and (out := _replaced(layer, _WIDE, lambda m: m[0].replace(b"\0", b""))):
        yield out
    if layer.low is not None:  # the text itself is UTF-8, which compressed data are not
        for m in _HEADER.finditer(layer.data):
            for piece in _pieces(memoryview(layer.data)[m.start():]):
                yield layer.inside(m.start(), len(layer.data), piece)
    yield from _base64(layer)


def secrets(data: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the base spans of the text itself, and of all spans, in code points and in order."""
    first = Layer(data)
    base = [(s, k, e) for k, s, e in _found(first) if k < BASE]
    every = set()
    seen, work = set(), [iter([first])]  # layers are made one at a time
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        digest = hashlib.blake2b(layer.data, digest_size=16).digest()
        if layer.low is not None and len(layer.data):
            digest += b"%d:%d" % (layer.low[0], layer.high[-1])
        if digest in seen:
            continue
        seen.add(digest)
        for kind, s, e in _found(layer):
            low, high = layer.span(s, e)
            every.add((low, kind, high))
        work.append(_unwrapped(layer))
    if not every:
        return [], []
    whole_bytes = np.frombuffer(data, np.uint8)
    point = np.concatenate([[0], np.cumsum((whole_bytes & 0xC0) != 0x80)])

    def points(spans):
        return sorted((int(point[s]), k, int(point[e])) for s, k, e in spans)

    return points(base), points(every | set(base))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        rows = [secrets(v.as_buffer().to_pybytes()) for v in b.column("text")]
        counts = [[sum(k == kind for _, k, _ in base) for base, _ in rows] for kind in range(BASE)]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
             pa.array([written(base) for base, _ in rows]), pa.array([written(every) for _, every in rows])],
            ["doc_id", *[f"n_{k}" for k in KINDS[:BASE]], "base_spans", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) for every row of ``docs``.

    Spans read kind:start:end in code points, the end exclusive, by start and
    then by kind as listed in ``KINDS``, joined by commas. A null or empty
    text has none. Rows are independent: repeated rows and null ids pass
    through, an empty table gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text")).mapInArrow(
        _scan, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string")


def redacted(data: bytes, mark: str = "[secret]") -> str:
    """The text with every span replaced; spans that overlap are replaced together."""
    text = data.decode("utf-8", "replace")
    out, at = [], 0
    for start, _, end in secrets(data)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


@F.arrow_udf(StringType())
def _redact(column: pa.Array) -> pa.Array:
    return pa.array([redacted(v.as_buffer().to_pybytes()) for v in column], pa.string())


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` brought in line; null texts stay null."""
    out = docs.withColumn("text", F.when(F.col("text").isNotNull(), _redact(whole())))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))
    return out
