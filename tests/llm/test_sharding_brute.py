"""Shards against the published function, one key at a time."""

import zlib
from collections import defaultdict

from adtally.llm.queries import QUERIES

WORD = 2**64


def published(key, shards):
    at, shard = 0, -1
    while at < shards:
        shard = at
        key = (key * 2862933555777941757 + 1) % WORD
        at = int((shard + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return shard


def spread(number):
    number = (number ^ number >> 32) * 0x9E3779B97F4A7C15 % WORD
    number = (number ^ number >> 29) * 0xC2B2AE3D27D4EB4F % WORD
    return number ^ number >> 32


def test_query_equals_the_published_function(spark, sf, texts):
    got = {r.doc_id: r for r in QUERIES["op1_jump_sharding"](spark, sf).collect()}
    assert len(got) == len(texts)
    order = defaultdict(list)
    for doc_id, text in texts:
        data, key, row = (text or "").encode(), spread((doc_id + 1) % WORD), got[doc_id]
        assert (row.shard, row.grown_shard) == (published(key, 8), published(key, 9))
        assert row.grown_shard in (row.shard, 8)
        assert (row.size, row.text_crc32, row.law) == (len(data) + 1, zlib.crc32(data), "key")
        order[row.shard].append((doc_id, row.slot))
    for rows in order.values():
        assert [slot for _, slot in sorted(rows)] == list(range(len(rows)))
