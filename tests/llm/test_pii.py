"""Personal data against plain patterns over whole texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from adtally.llm import pii
from adtally.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def doubled(d):
    return 2 * d - 9 if d > 4 else 2 * d


def plain(text):
    """Base spans by the definition."""
    def digits(m):
        return [int(c) for c in m[0] if c.isdigit()]

    def luhn(ds):
        return sum(doubled(d) if i % 2 else d for i, d in enumerate(reversed(ds))) % 10 == 0

    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    ]


ALPHABETS = ["a.@-", "ab@.%+ é", "0123456789 -", "12.", "+1 ().-9", "+0123456789 .()-@a", "19 -.+@a:/é\U0001f600"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_base_spans_of_random_texts(alphabet):
    draw = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(draw.choices(alphabet, k=draw.randrange(60)))
        assert pii.personal(text)[:4] == plain(text), text


def test_cards_with_separators():
    draw = random.Random(5)
    hits = 0
    for _ in range(3000):
        number = "".join(draw.choice("0123456789") + draw.choice(["", "", " ", "-"]) for _ in range(draw.randrange(11, 22)))
        text = "x " + number + draw.choice(["", ".", " y", "--1"])
        found = plain(text)
        hits += len(found[2])
        assert pii.personal(text)[:4] == found
    assert hits > 100


def kinds(text):
    return {k: [text[s:e] for s, e in found] for k, found in zip(pii.KINDS, pii.personal(text)) if found}


def test_added_kinds():
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32, paid")["iban"] == ["GB82 WEST 1234 5698 7654 32"]
    assert "iban" not in kinds("IBAN: GB83 WEST 1234 5698 7654 32")  # wrong check digits
    assert kinds("Account no. 12345678 closed") == {"account": ["12345678"]}
    assert kinds("accountant 12345678") == {}
    assert kinds("my SSN is 123-45-6789.")["ssn"] == ["123-45-6789"]
    assert kinds("passport number: X1234567") == {"passport": ["X1234567"]}
    assert kinds("see https://bob:pw1@host.example/x")["login"] == ["https://bob:pw1@host.example"]
    assert kinds("see https://host.example/x@y") == {}
    assert kinds("the account of the passport of an iban") == {}


@pytest.mark.parametrize("text", ["1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@" * 200_000, "a" * 400_000 + "@b.c",
                                  "1 " * 200_000, "+1" + "(" * 400_000, "account " * 50_000, "a://" * 100_000,
                                  "account" + " no" * 100_000])
def test_long_texts_take_linear_time(text):
    import time
    began = time.process_time()
    assert pii.personal(text)[0] == (plain(text)[0] if "@b" in text else [])
    assert time.process_time() - began < 5


def test_rows(spark):
    rows = [(1, "a@b.cd", "x"), (1, "a@b.cd", "x"), (None, "call +49 (30) 1234567", None), (2, None, "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, spans string")
    found = sorted(pii.scan_pii(docs).collect(), key=str)
    assert [(r.doc_id, r.n_email, r.n_phone, r.spans) for r in found] == [
        (1, 1, 0, "email:0:6"), (1, 1, 0, "email:0:6"), (2, 0, 0, ""), (3, 0, 0, ""), (None, 0, 1, "phone:5:21")]
    assert pii.scan_pii(docs.limit(0)).count() == 0
    hidden = pii.mask_pii(docs)
    assert hidden.columns == docs.columns
    assert sorted(str(r.text) for r in hidden.collect()) == ["", "None", "[email]", "[email]", "call [phone]"]


def test_query_equals_patterns(spark, sf):
    import hashlib
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op12_pii_anchors"](spark, sf).collect()}
    assert len(got) == len(docs)
    for row in docs:
        found = plain(row.text or "")
        base = ",".join(f"{k}:{s}:{e}" for k, spans in zip(pii.KINDS, found) for s, e in spans)
        out = got[row.doc_id]
        assert out.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [out.n_email, out.n_ip, out.n_card, out.n_phone] == [len(f) for f in found]
        assert set(filter(None, base.split(","))) <= set(out.spans.split(","))


def test_sql_gives_the_same_counts(spark, sf):
    """Emails and numbers counted by another engine's patterns."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counted = docs.select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(EMAIL.pattern)).alias("n"))
    got = QUERIES["op12_pii_anchors"](spark, sf).select("doc_id", "n_email")
    assert counted.join(got, "doc_id").where("n != n_email").count() == 0
