import zlib

import numpy as np

from strandframe.llm import sharding


def brute_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_loop():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [brute_jump(int(k), n) for k in keys]
    a, b = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    assert set(b[a != b].tolist()) == {24} and 60 < (a != b).sum() < 190


def test_shards(spark):
    rows = [(i % 400 if i % 50 else None, ["", None, "é" * 10, f"text {i}"][i % 4], 3) for i in range(2000)] + [(5, "copy", 3)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(6)
    got = sharding.shard(docs, 24).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24 and r.law == "key"
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len({r.shard for r in got if r.id == 5}) == 1
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.id), r.size, r.text_crc32) for r in got) == want
    assert sharding.shard(docs.limit(0)).count() == 0
