import zlib
from collections import defaultdict

import numpy as np

from tidemark.llm import sharding


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_matches_the_published_loop_and_moves_only_into_the_new_shard():
    keys = np.array([0, 1, 2**63, 2**64 - 1, *range(1000, 3000)], np.uint64)
    for n in (1, 2, 8, 9, 100):
        assert sharding.jump(keys, n).tolist() == [jump_one(int(k), n) for k in keys]
    old, new = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert set(new[old != new].tolist()) == {8} and 0.05 < (old != new).mean() < 0.17


def test_assign(docs, odd, spark):
    for frame in (docs, odd):
        rows = sharding.assign(frame).collect()
        texts = sorted((len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in frame.collect())
        assert sorted((r["size"], r["text_crc32"]) for r in rows) == texts
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(odd.limit(0)).count() == 0
    named = spark.createDataFrame([("a", "x"), (None, None)], "doc_id string, text string")
    assert sharding.assign(named).count() == 2
