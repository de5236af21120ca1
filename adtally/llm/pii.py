"""Personal data: anchors found by one automaton, spans by local parsers.

An Aho-Corasick automaton runs over a text once and reports anchors: at-signs,
``://``, a plus before a digit, a dot between digits, digits in a row, and
words that announce an identifier. A parser that belongs to the anchor then
expands it to both sides as far as characters allow and validates what it
got. No pattern is ever tried elsewhere. Each parser remembers how far it has
read, so that a text is read once by each however many anchors it has.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from adtally.llm.text import slices, whole

#: Kinds in the order of reports; the first four are the base kinds.
KINDS = ["email", "ip", "card", "phone", "login", "iban", "account", "ssn", "passport"]
BASE = 4
#: Words that announce an identifier, and its kind.
CUES = {
    "iban": "iban", "account": "account", "acct": "account", "konto": "account", "cuenta": "account",
    "compte": "account", "ssn": "ssn", "social security": "ssn", "passport": "passport", "pasaporte": "passport",
    "passeport": "passport", "reisepass": "passport",
}
_DIGITS = "0123456789"
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
# Read from a place on; possessive, so that nothing is ever tried twice.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]++")
_AUTHORITY = re.compile(r"[^\s/?#@:\"'<>]++:[^\s/?#@\"'<>]++@[A-Za-z0-9.\[\]-]++(?::[0-9]{1,5}+)?+")
#: What may stand between a cue and its identifier.
_LEAD = re.compile(r"(?:[ \t]*+(?:number|num|nr|no|id|is|code|nummer|número|numéro|[.:#=]))*+[ \t]*+", re.IGNORECASE)
_IDENTIFIER = {
    "iban": re.compile(r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+)(?![A-Za-z0-9])"),
    "account": re.compile(r"([0-9](?:[ -]?[0-9]){6,16}+)(?![A-Za-z0-9])"),
    "ssn": re.compile(r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "passport": re.compile(r"((?=[A-Z0-9]{0,8}[0-9]{5})[A-Z0-9]{7,9})(?![A-Za-z0-9])"),
}


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """Every anchor with the kind that it calls for and its length."""
    found = {"@": "email", "://": "login"}
    for x in _DIGITS:
        found["+" + x] = "phone"
        for y in _DIGITS:
            found[f"{x}.{y}"] = "ip"
            found |= {f"{x}{sep}{y}": "card" for sep in ("", " ", "-")}
    for cue, kind in CUES.items():
        found |= {form: kind for form in (cue, cue.upper(), cue.capitalize(), cue.title())}
    automaton = ahocorasick.Automaton()
    for word, kind in found.items():
        automaton.add_word(word, (KINDS.index(kind), len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def _left(text: str, at: int, least: int, allowed: frozenset[str] | str) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


# A parser gets the text, where the anchor begins and ends, and up to where its kind has read. It returns up to where
# it has read now, and its spans.

def _email(text: str, start: int, end: int, read: int):
    local = _left(text, start, read, _LOCAL)
    domain = _DOMAIN.match(text, end) if local < start else None
    return (domain.end(), [(local, domain.end())]) if domain else (read, [])


def _ip(text: str, start: int, end: int, read: int):
    start = _left(text, start, read, _DIGITS)
    chain = _CHAIN.match(text, start)
    parts, spans, at = chain[0].split("."), [], start
    for i in range(0, len(parts) - 3, 4):
        four = parts[i:i + 4]
        size = sum(map(len, four)) + 3
        if all(map(_byte, four)):
            spans.append((at, at + size))
        at += size + 1
    return chain.end(), spans


def _card(text: str, start: int, end: int, read: int):
    run = _GROUPED.match(text, start)
    if run.end() - start > 40:  # nineteen digits take 37 characters at most
        return run.end(), []
    digits = run[0].replace(" ", "").replace("-", "")
    return run.end(), [(start, run.end())] if 13 <= len(digits) <= 19 and luhn(digits) else []


def _phone(text: str, start: int, end: int, read: int):
    run = _DIALLED.match(text, start)
    if not run:
        return read, []
    number = run[0].rstrip(" ().-")
    # A plus, a digit, at least one more character and a last digit.
    ok = len(number) >= 4 and 9 <= sum(c in _DIGITS for c in number) <= 15
    return run.end(), [(start, start + len(number))] if ok else []


def _login(text: str, start: int, end: int, read: int):
    scheme = _left(text, start, read, _SCHEME)
    authority = _AUTHORITY.match(text, end) if scheme < start else None
    return (authority.end(), [(scheme, authority.end())]) if authority else (end, [])


def _identifier(kind: str):
    pattern = _IDENTIFIER[kind]

    def parse(text: str, start: int, end: int, read: int):
        if start and text[start - 1].isalnum() or text[end:end + 1].isalpha():
            return read, []  # part of a longer word
        found = pattern.match(text, _LEAD.match(text, end).end())
        if not found or (kind == "iban" and not _mod97(found[1].replace(" ", ""))):
            return end, []
        return found.end(1), [found.span(1)]

    return parse


PARSERS = [_email, _ip, _card, _phone, _login, *map(_identifier, KINDS[5:])]


def personal(text: str) -> list[list[tuple[int, int]]]:
    """For each kind its spans in code points, in order."""
    spans: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    read = [0] * len(KINDS)
    for last, (kind, length) in anchors().iter(text):
        start = last + 1 - length
        if start >= read[kind]:
            read[kind], found = PARSERS[kind](text, start, last + 1, read[kind])
            if found:
                spans[kind] += found
    return spans


def written(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, found in zip(KINDS, spans) for s, e in found)


def _text(value: pa.Scalar) -> str:
    return value.as_buffer().to_pybytes().decode("utf-8", "replace")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        rows = [personal(_text(v)) for v in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array([len(r[k]) for r in rows], pa.int64()) for k in range(BASE)],
             pa.array([written(r[:BASE]) for r in rows], pa.string()), pa.array([written(r) for r in rows], pa.string())],
            ["doc_id", *[f"n_{k}" for k in KINDS[:BASE]], "base_spans", "spans"])


def scan_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans) for every row of ``docs``.

    Spans read kind:start:end in code points, the end exclusive, by kind as
    listed in ``KINDS`` and then by start, joined by commas. A null or empty
    text has none. Rows are independent: repeated rows and null ids pass
    through, an empty table gives an empty result, other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text")).mapInArrow(
        _scan, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced together."""
    spans = sorted((s, e, kind) for kind, found in zip(KINDS, personal(text)) for s, e in found)
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


@F.arrow_udf(StringType())
def _mask(column: pa.Array) -> pa.Array:
    return pa.array([masked(_text(v)) for v in column], pa.string())


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, all columns as they are otherwise; null texts stay null."""
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), _mask(whole())))
