"""Each corpus operator against a brute-force version, and its edge cases."""

import base64
import bz2
import gzip
import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import functions as F

from adtally.llm import bytebpe, decontaminate, license_rules, neardup, neighbours, queries, secrets, tokencount
from adtally.llm.bytebpe import encode_decode
from adtally.llm.decontaminate import contaminated, without_contaminated
from adtally.llm.graph import components
from adtally.llm.licenses import scan_licenses
from adtally.llm.neardup import near_duplicates
from adtally.llm.neighbours import nearest
from adtally.llm.quality import good_rows, quality_scores
from adtally.llm.secrets import redact, redacted, scan_secrets
from adtally.llm.sharding import jump, shard_by_key
from adtally.llm.substrings import remove_repeats
from adtally.llm.text import hashes, words
from adtally.llm.tokencount import token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def edge_texts():
    from tests.llm.conftest import EDGES

    return [(i, t or "") for i, t, *_ in EDGES]


# words and hashes


def test_words_and_hashes():
    parts = [b"", b" a\tbb\n", b"\xc3\xa9x yy", b"longer-than-eight-bytes q", b"tail"]
    w = words(pa.array(parts, pa.binary()), lower=True)
    got = [bytes(w.data[s:e]) for s, e in zip(w.starts, w.ends)]
    assert got == [x for p in parts for x in p.lower().split()]
    assert w.first.tolist() == np.cumsum([0] + [len(p.split()) for p in parts]).tolist()
    keys = hashes(w.data, w.starts, w.ends)
    again = words(pa.array([b"  ".join(got)], pa.binary()), lower=True)
    assert keys.tolist() == hashes(again.data, again.starts, again.ends).tolist() and len(set(keys.tolist())) == len(set(got))


# 1


def test_jump_moves_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    for n in (1, 2, 8, 9, 30):
        a, b = jump(keys.copy(), n), jump(keys.copy(), n + 1)
        assert a.max() < n and ((a == b) | (b == n)).all()
        assert abs((b == n).mean() - 1 / (n + 1)) < 0.03


def test_sharding(edges, nothing, documents):
    rows = shard_by_key(edges, 8).collect()
    assert len(rows) == edges.count() and shard_by_key(nothing, 8).count() == 0
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in edge_texts())
    rows = shard_by_key(documents.repartition(5), 8).collect()
    for s in range(8):
        own = sorted((r.slot, r.doc_id) for r in rows if r["shard"] == s)
        assert [k for k, _ in own] == list(range(len(own))) and [d for _, d in own] == sorted(d for _, d in own)
    assert all(r.grown_shard in (r["shard"], 8) for r in rows)


# 2


def test_rules_are_distinct_and_gated():
    rules = license_rules.RULES
    assert len(rules) > 300 and len({(r.pattern, r.base) for r in rules}) >= len(rules) - 1
    for r in rules:
        plain, before = license_rules.over_words(r.pattern), None
        while plain != before:  # what may be missing does not count
            before, plain = plain, re.sub(r"\(\?:[^()]*\)\?", "", plain)
        plain += r.keyword.replace(" ", "  ")
        assert any(g in plain.replace("licen[cs]e", "license") for g in license_rules.GATE), r


def base_places(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       text.translate({c: c + 32 for c in range(65, 91)}))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    places = [(i, label) for i in range(len(found)) for p, label in phrases.items()
              if found[i:i + len(p.split())] == p.split()]
    return found, places


def test_licenses(spark, edges, nothing, texts):
    more = ["MIT License, the mit-license.MIT LICENSE", "Licensed under CC BY-NC-SA 4.0!",
            "SPDX-License-Identifier: Apache-2.0", "GNU General Public License, version 2 or any later version",
            "the MITlicense, mit licenses; mit\tlicense"] + ["mit license " * 3000]
    rows = [(i, t) for i, (_, t) in enumerate(texts + edge_texts() + [(0, m) for m in more])]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        found, places = base_places(text)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(found), len(places))
        assert r.first_word == min((p for p, _ in places), default=None)
        assert r.last_word == max((p for p, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    by_text = {t: got[i] for i, t in rows}
    assert by_text[more[1]].labels == "cc-by,cc-by-nc-sa-4.0"  # the name lies inside the longer detection
    assert by_text[more[2]].score == 1.0 and "apache-2.0" in by_text[more[2]].labels
    assert by_text[more[3]].labels == "gpl,gpl-2.0-or-later"
    assert scan_licenses(edges).count() == edges.count() and scan_licenses(nothing).count() == 0


def test_licenses_use_no_python(edges):
    plan = scan_licenses(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# 3


def test_neighbours_whole_visit_is_exact(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(600, 6)).round(1)
    points[50:150] = points[50]  # many equal vectors
    rows = [(i, [float(x) for x in p], "x") for i, p in enumerate(points)]
    rows += [(900, None, "n"), (1000, [0.0] * 6, "n"), (1100, [1.0] * 5 + [float("nan")], "n"), (None, [1.0] * 6, "n"),
             (1200, [1.0, None, 1.0, 1.0, 1.0, 1.0], "n"), (1300, [1.0] * 4, "n"), (3, rows[3][1], "copy")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score)
           for r in nearest(frame, F.col("vec_id") % 50 == 0, visit=1.0).collect()}
    wanted = {}
    usable = [i for i in range(600) if points[i].any()]
    for q in (i for i in usable if i % 50 == 0):
        d = sorted((float(np.sqrt(((points[i] - points[q]) ** 2).sum())), i) for i in usable if i != q)[:10]
        wanted |= {(q, k + 1): (i, s) for k, (s, i) in enumerate(d)}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in wanted.items()}
    assert all(abs(got[k][1] - v[1]) < 1e-12 for k, v in wanted.items())
    assert nearest(frame.limit(0), F.lit(True)).count() == 0
    assert nearest(frame.where("vec_id in (1, 2, 3)"), F.col("vec_id") == 1).count() == 2


def test_cells_are_visited_in_order():
    rng = np.random.default_rng(2)
    books = [rng.normal(size=(5, 3)), rng.normal(size=(7, 3))]
    query = rng.normal(size=6)
    got = neighbours.visited(query, books, np.ones(35, np.int64), 35)
    cost = [((query[:3] - books[0][c // 7]) ** 2).sum() + ((query[3:] - books[1][c % 7]) ** 2).sum() for c in got]
    assert sorted(got) == list(range(35)) and all(a <= b + 1e-12 for a, b in zip(cost, cost[1:]))


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in frame.collect()}
    hits = total = 0
    found = {}
    for r in nearest(frame, F.col("vec_id") % 25 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, own in found.items():
        best = sorted((float(np.linalg.norm(v - vectors[q])), i) for i, v in vectors.items() if i != q)[:10]
        hits += len(own & {i for _, i in best})
        total += len(best)
    assert total and hits / total >= 0.9


# 4


def base_spans(text):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


SECRETS = [
    "é password: hunter22 PASSWD='abc' secret=token:abcdefgh tokKen=abcdefg ſecret=abcdefg",
    "AKIAAKIA short AKIA" + "Z" * 16 + " " + "ab12" * 8 + "G" + "0" * 23,
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" api_key=a.b/c+d',
]


def test_base_secrets(spark, edges, nothing, texts):
    rows = [(i, t) for i, (_, t) in enumerate(texts + edge_texts() + [(0, s) for s in SECRETS])]
    for r in scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        found = base_spans(rows[r.doc_id][1])
        said = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in found)
        assert (r.base_spans, r.n_assign, r.n_access, r.n_hex) == (
            said, *(sum(k == kind for _, k, _ in found) for kind in range(3)))
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
    assert scan_secrets(edges).count() == edges.count() and scan_secrets(nothing).count() == 0


def _percent(data):
    return "".join(f"%{b:02X}" for b in data).encode()


def _unicode(data):
    return "".join(f"\\u{b:04x}" for b in data).encode()


@pytest.mark.parametrize("wrap", [
    _percent, _unicode, base64.b64encode, base64.urlsafe_b64encode,
    lambda d: base64.b64encode(gzip.compress(d)), lambda d: base64.b64encode(zlib.compress(d)),
    lambda d: base64.b64encode(bz2.compress(d)), lambda d: base64.b64encode(zstandard.compress(d)),
    lambda d: _percent(base64.b64encode(gzip.compress(base64.b64encode(_unicode(d)))))])
def test_encoded_secrets(wrap):
    hidden = wrap(b"password=correct-horse-battery").decode()
    text = f"ünder {hidden} here"
    spans = secrets.secrets(text.encode())[1]
    kinds = [(s, e) for s, k, e in spans if k == 0]
    assert kinds and all(6 <= s < e <= 6 + len(hidden) for s, e in kinds)
    assert hidden not in redacted(text.encode()) and redacted(text.encode()).endswith(" here")


def test_layers_end():
    assert secrets.secrets(base64.b64encode(gzip.compress(b"\0" * 30_000_000)))[1] == []
    assert secrets.secrets(_percent(_percent(_percent(b"plain words")))) == ([], [])


def test_redaction_keeps_columns(edges, spark):
    out = redact(edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    row = redact(spark.createDataFrame([(1, 'a token = "04dbebab91ab" b', 99)], "doc_id long, text string, n_chars long")).first()
    assert row.text == 'a [secret]" b' and row.n_chars == len(row.text)


# 5


def brute_leaks(docs, items):
    out = {}
    for d, text in docs:
        w = text.encode().lower().split()
        for i, item in items:
            x = item.encode().lower().split()
            g = min(5, len(x))
            if not x or len(w) < len(x):
                continue
            bag = Counter(tuple(x[k:k + g]) for k in range(len(x) - g + 1))
            grams = [tuple(w[k:k + g]) for k in range(len(w) - g + 1)]
            if not set(grams) & set(bag):
                continue
            for p in range(len(w) - len(x) + 1):
                own = Counter(grams[p:p + len(x) - g + 1])
                alike = sum((own & bag).values()) / sum((own | bag).values())
                if alike >= 0.8 and alike > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (alike, p)
    return out


def test_contamination(spark, edges, nothing, texts, sf, documents):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    i, item = items[0]
    w = item.split()
    changed = " ".join(["pre"] + w[:20] + ["CHANGED"] + w[21:]) if len(w) > 60 else " ".join(["Pre", *w[:-1], "other"])
    extra = [(-1, changed), (-2, item.upper()), (-3, "x " + "one two three" + " y")]
    items += [(900, "One two three"), (901, ""), (902, "  ")]
    docs = spark.createDataFrame(texts + extra, "doc_id bigint, text string")
    bench = spark.createDataFrame(items + [(903, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in contaminated(docs, bench).collect()}
    wanted = brute_leaks(texts + extra, items)
    assert got.keys() == wanted.keys() and all(abs(got[k][0] - v[0]) < 1e-12 and got[k][1] == v[1] for k, v in wanted.items())
    assert (-2, i) in got and (-3, 900) in got
    assert contaminated(edges, benchmark).count() == 0 and contaminated(nothing, benchmark).count() == 0
    assert contaminated(documents, benchmark.limit(0)).count() == 0
    kept = without_contaminated(documents, benchmark)
    leaking = {d for d, _ in got if d >= 0}
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - leaking
    assert without_contaminated(edges, benchmark).count() == edges.count()


def test_every_print_within_the_radius_is_found():
    rng = np.random.default_rng(3)
    items = pa.table({"item_id": list(range(40)), "text": pa.array(
        [" ".join(f"w{x}" for x in rng.integers(0, 50, 12)).encode() for _ in range(40)], pa.binary())})
    (group,) = decontaminate.groups(items)
    prints = group.prints[rng.integers(0, 40, 300)]
    for k in range(300):
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    got = set(zip(*(x.tolist() for x in decontaminate._near(group, prints))))
    assert got == {(k, m) for k in range(300) for m in range(40)
                   if int(prints[k] ^ group.prints[m]).bit_count() <= decontaminate.RADIUS}


# 6


def brute_repeats(rows, size):
    seen, out = set(), {}
    for d, text in sorted(rows):
        w, gone = text.encode().split(), set()
        for p in range(len(w) - size + 1):
            key = tuple(w[p:p + size])
            if key in seen:
                gone.update(range(p, p + size))
            seen.add(key)
        out[d] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_repeats(spark, edges, nothing, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept))
           for r in remove_repeats(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4), 12).collect()}
    assert got == brute_repeats(texts, 20)
    rows = remove_repeats(edges, 12).collect()
    assert len(rows) == edges.count() and remove_repeats(nothing, 12).count() == 0
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0, 0]  # rows that repeat id and text are one document


def test_repeats_with_heavy_minimisers(spark):
    rng = np.random.default_rng(4)
    line = " ".join(f"common{i}" for i in range(9))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 9, 15)) + f" {line} " + " ".join(f"v{x}" for x in rng.integers(0, 9, 15)))
            for i in range(150)]
    rows += [(i + 500, t) for i, t in rows[::3]]
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept))
           for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6), 400, 8, 3).collect()}
    assert got == brute_repeats(rows, 8)


# 7


def test_quality(spark, edges, nothing):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert sum(p == q for p, q in held) / len(held) > 0.9
    turned = labels.withColumn("quality", F.when(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"),
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality_scores(docs, turned).collect())) == sorted(map(tuple, rows))  # never looked at
    assert good_rows(docs, labels).columns == docs.columns
    assert quality_scores(edges, labels).count() == edges.count() and quality_scores(nothing, labels).count() == 0
    assert {r.predicted for r in quality_scores(edges, labels.limit(0)).collect()} == {1}


# 8


def test_token_counts(spark, edges, nothing, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = ["  two  spaces ", "▁▁a▁", "<s> </s> <0x0A>", "\n\n\t", "ab" * 500, "ﬁ Ａ é", "\x00 \x1c"]
    rows = [(i, t) for i, (_, t) in enumerate(texts + edge_texts() + [(0, o) for o in odd])]
    for r in token_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), PIECES).collect():
        text = rows[r.doc_id][1]
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text)))
    assert token_counts(edges, PIECES).count() == edges.count() and token_counts(nothing, PIECES).count() == 0


def test_random_tokens_agree():
    rng, library, model = np.random.default_rng(6), sentencepiece.SentencePieceProcessor(model_file=PIECES), tokencount.Model(PIECES)
    for _ in range(1500):
        text = "".join(rng.choice(list("abcdethins  \n▁é漢😀.,"), rng.integers(1, 60)))
        assert model.counts(model.pre_tokens(text)).sum() == len(library.encode(text)), repr(text)


# 9


def test_byte_bpe(spark, edges, nothing, texts):
    known = bytebpe.Vocabulary(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    odd = ["<|endoftext|>", "a" * 3000, "\r\n \x85\xa0x", "zq" * 999, "it's we'LL"]
    rows = [(i, t) for i, (_, t) in enumerate(texts + edge_texts() + [(0, o) for o in odd])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in encode_decode(frame, RANKS, public_tokenizers.PATTERN).collect():
        text = rows[r.doc_id][1]
        ids = library.encode_ordinary(text)
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids)
        assert bytes(r.decoded) == text.encode()
    assert encode_decode(edges, RANKS, public_tokenizers.PATTERN).count() == edges.count()
    assert encode_decode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(8).integers(0, 2**63, 4000).astype(np.uint64))
    assert sorted(bytebpe.PerfectHash(keys).slots(keys).tolist()) == list(range(len(keys)))


# 10


def brute_components(rows, size):
    sets = {}
    for d, text in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        sets[d] = grams
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, texts, size):
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 3000, 120)]
    family = []
    for k in range(60):  # loose enough that a star alone loses links
        w = list(base)
        for p in rng.choice(120, rng.integers(1, 9), replace=False):
            w[p] = f"n{rng.integers(0, 3000)}"
        family.append((10_000 + int(rng.integers(0, 900)) * 100 + k, " ".join(w)))
    rows = texts + family + [(77_777_001, "One"), (77_777_002, "one"), (77_777_003, "two")]
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size).collect()}
    for d, (n, component) in brute_components(rows, size).items():
        assert (got[d].n_shingles, got[d].component_id, got[d].kept) == (n, component, d == component)


def test_near_duplicates_at_the_edges(edges, nothing):
    rows = near_duplicates(edges, 2).collect()
    assert len(rows) == edges.count() and near_duplicates(nothing, 2).count() == 0
    assert all(r.kept and r.component_id == r.doc_id for r in rows)
    assert [r.n_shingles for r in rows if r.doc_id in (2, 3, 4)] == [0, 0, 0]


def test_overlaps():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 4000, rng.integers(1, 3000)).astype(np.uint32)) for _ in range(12)]
    a, b = (x.ravel() for x in np.triu_indices(12, 1))
    both, either = neardup._overlaps(sets, a, b)
    assert both.tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]
    assert either.tolist() == [len(np.union1d(sets[i], sets[j])) for i, j in zip(a, b)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(None, 5), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()))
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_all_thirteen_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
