"""Alignment of tokens against the libraries over whole texts, one document at a time."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from adtally.llm import alignment
from adtally.llm.alignment import NOTHING, Sizes, compose, fragment
from adtally.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encode():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        """Groups as lists of ids, or None."""
        if not text:
            return None
        data = (" " + text).encode()
        mine = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        other = [(i, piece(i)) for i in b.encode(text)]
        if b"".join(x for _, x in mine) != data or b"".join(x for _, x in other) != data:
            return None
        ends = []
        for tokens in (mine, other):
            at, found = 0, {}
            for i, x in tokens:
                at += len(x)
                found[at] = i
            ends.append(found)
        groups, left = [], ([], [])
        for at in sorted(ends[0] | ends[1]):
            for k in (0, 1):
                if at in ends[k]:
                    left[k].append(ends[k][at])
            if at in ends[0] and at in ends[1]:
                groups.append(left)
                left = ([], [])
        return groups

    return both


def plain(texts, both):
    """Expected rows, by the definition."""
    groups = [both(t) for t in texts]
    count, links = Counter(), []
    for g in groups:
        mine = [(a, b) for x, y in g or [] for a in x for b in y]
        links.append(mine)
        count.update(set(mine))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for g, mine in zip(groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), len(mine),
                    sum(count[p] == best[p[0]] for p in mine), sum(count[p] for p in mine),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def got(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]


def test_query_equals_libraries(spark, sf, encode):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = sorted(QUERIES["op13_fragment_alignment"](spark, sf).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [r.doc_id for r in docs]
    assert got(rows) == plain([r.text for r in docs], encode)


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "x\t y\r\nz", "　a b᠎ c", "a▁b c", "a ▁b",
       "  a", "ﬁ ½ é é é", "漢字 かな 😀👩‍👩‍👧 \U0001f600", "<|endoftext|> <s> </s> <unk> <0x41>", "don't we'll  'tis",
       "a b  c", "\x00 \x1f a \x1c b", "1234567 89,01 % $ €", "-" * 50 + " " * 9 + "=" * 50, "!!!??  !", "﻿a b"]


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id int, text string, row string, n_a int").repartition(3)


@pytest.mark.parametrize("sizes", [Sizes(pairs=50, remembered=100), Sizes(long=40, range=7, fan=2)])
def test_odd_texts(spark, encode, sizes):
    """The same rows from texts in one task, and from texts dealt out in small pieces and composed in a tree."""
    draw = random.Random(1)
    texts = [*ODD, *["".join(draw.choices(["a", "b", "The", " ", " ", "  ", "\n", "é", "字", "123", ".", "'s"], k=draw.randrange(400)))
                     for _ in range(60)], "ab" * 300, "zq" * 400 + " of it", "the cat sat " * 200, "the cat sat " * 200]
    rows = sorted(alignment.align_tokens(frame(spark, texts), A, B, sizes).collect(), key=lambda r: r.doc_id)
    assert got(rows) == plain(texts, encode)
    groups = alignment.token_groups(frame(spark, texts), A, B, sizes).collect()
    put = {}
    for r in sorted(groups, key=lambda r: (r.doc_id, r.place or 0)):
        put.setdefault(r.doc_id, []).append(r.groups)
    for row in rows:
        text = ";".join(put.get(row.doc_id, [""]))
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == row.groups_sha256


def test_long_texts_with_and_without_blanks(spark, encode):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghiklmnop", k=draw.randrange(1, 9))) for _ in range(500)]
    texts = [" ".join(draw.choices(words, k=40_000)), "".join(draw.choices("abcdefgh0123456789+/", k=150_000)),
             " ".join(draw.choices(words, k=30_000)) + " ▁", " ".join(draw.choices(words, k=50))]
    rows = sorted(alignment.align_tokens(frame(spark, texts), A, B).collect(), key=lambda r: r.doc_id)
    assert got(rows) == plain(texts, encode)
    assert rows[2].n_a == 0


def test_rows(spark, edges, nothing, encode):
    rows = alignment.align_tokens(edges, A, B).collect()
    texts = [r.text for r in edges.collect()]
    assert sorted(got(rows)) == sorted(plain(texts, encode))
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edges.collect())
    assert alignment.align_tokens(nothing, A, B).count() == 0


def same(f, g):
    return all(np.array_equal(x, y) for x, y in zip(f, g))


def test_fragments_compose_in_any_tree():
    draw = random.Random(3)
    for _ in range(200):
        ends = [sorted({*draw.sample(range(1, 40), draw.randrange(0, 12)), 40}) for _ in (0, 1)]
        ids = [np.array(draw.choices(range(9), k=len(e))) for e in ends]
        ends = [np.array(e) for e in ends]
        cuts = [0, *sorted(draw.sample(range(1, 40), draw.randrange(0, 6))), 40]
        parts = []
        for low, high in zip(cuts, cuts[1:]):
            some = [(e > low) & (e <= high) for e in ends]
            parts.append(fragment(*[i[s] for i, s in zip(ids, some)], *[e[s] for e, s in zip(ends, some)]))
        total = fragment(*ids, *ends)
        while len(parts) > 1:
            i = draw.randrange(len(parts) - 1)
            parts[i:i + 2] = [compose(*parts[i:i + 2])]
        assert same(parts[0], total)
        assert same(compose(NOTHING, total), total) and same(compose(total, NOTHING), total)
