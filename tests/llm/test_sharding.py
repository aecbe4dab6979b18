import hashlib
import zlib

import pytest
from rows import awkward, documents

from ratewell.llm.sharding import shard_by_bytes


@pytest.mark.parametrize("clashing", [False, True])
def test_sizes_slots_and_groups(spark, clashing):
    rows = awkward()
    found = shard_by_bytes(documents(spark, rows, clashing), shards=4).collect()
    body = lambda t: (t or "").encode()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in found) == sorted(
        (i or -1, len(body(t)) + 8, zlib.crc32(body(t))) for i, t in rows
    )
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    by = {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None
        by.setdefault(r.shard, []).append(r)
    for shard, some in by.items():
        assert 0 <= shard < 4
        assert sorted(r.slot for r in some) == list(range(len(some)))
    cuts, at = [], 0
    for shard in range(4):
        at += sum(r["size"] for r in by.get(shard, []))
        cuts.append(at)
    assert all(abs(c - total * (k + 1) / 4) <= largest for k, c in enumerate(cuts))


def test_copies_stand_together_and_tables_may_be_empty(spark):
    rows = [(k, f"text {k % 5} " * 20) for k in range(200)]
    found = shard_by_bytes(documents(spark, rows), shards=3).collect()
    runs = [r.text_crc32 for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert sum(a != b for a, b in zip(runs, runs[1:])) == 4
    assert shard_by_bytes(documents(spark, []), shards=3).collect() == []


def test_near_equal_bytes_with_a_hot_group(spark):
    rows = [(k, "the same text for many" if k % 3 else f"own text {k} {'y' * (k % 40)}") for k in range(3000)]
    sums = {}
    for r in shard_by_bytes(documents(spark, rows), shards=24).collect():
        sums[r.shard] = sums.get(r.shard, 0) + r["size"]
    assert len(sums) == 24 and max(sums.values()) - min(sums.values()) <= 2 * 64


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_against_brute_force(spark, shards):
    rows = awkward()
    body = lambda t: (t or "").encode()
    line = sorted(rows, key=lambda r: (hashlib.md5(body(r[1])).hexdigest(), r[0] is not None, r[0] or 0))
    total, at, slots, expected = sum(len(body(t)) + 8 for _, t in rows), 0, {}, []
    for doc, text in line:
        size = len(body(text)) + 8
        shard = (2 * at + size) * shards // (2 * total)  # where the middle of the row falls
        expected.append((str(doc), size, zlib.crc32(body(text)), shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        at += size
    found = shard_by_bytes(documents(spark, rows).repartition(5), shards=shards).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot) for r in found) == sorted(expected)
