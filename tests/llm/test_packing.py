import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import packing


def check(rows, docs):
    """An exact round trip: each document's ids lie in its pieces once, sequences are gapless and not too long."""
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    want = defaultdict(list)
    for d in docs:
        want[d["doc_id"]].append(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_tokens"]))
    assert set(by_doc) == set(want)
    for doc_id, own in by_doc.items():
        assert sum(r["length"] for r in own) == sum(map(len, want[doc_id]))
        if len(want[doc_id]) == 1:
            ids, at = np.array(want[doc_id][0], "<u4"), 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
    for own in by_sequence.values():
        at = 0
        for offset, length, total in sorted(own):
            assert offset == at and total <= packing.WINDOW
            at += length
        assert at == total


def test_round_trip(docs, odd):
    for frame in (docs, odd):
        check(packing.pack(frame).collect(), frame.collect())
    assert packing.pack(docs.limit(0)).count() == 0


def test_little_padding(docs):
    rows = packing.pack(docs.coalesce(1)).where("offset = 0").collect()
    assert sum(r["padded_to"] - r["sequence_tokens"] for r in rows) < 0.01 * sum(r["padded_to"] for r in rows)


def test_cuts_cost_least():
    rng = random.Random(1)
    for _ in range(200):
        steps = [rng.randint(1, 9) for _ in range(rng.randint(1, 12))]
        at = np.cumsum([0, *steps])
        cost = np.array([0] + [rng.choice((0, 3, 7)) for _ in steps])
        cost[-1] = 0
        best = [0.0] + [float("inf")] * len(steps)
        for j in range(1, len(at)):
            for i in range(j):
                if at[j] - at[i] <= 12:
                    best[j] = min(best[j], best[i] + 12 - (at[j] - at[i]) + cost[j])
        cuts = packing.cut_windows(at, cost, 12)
        assert cuts[0] == 0 and cuts[-1] == len(steps)
        assert sum(12 - (at[b] - at[a]) + cost[b] for a, b in zip(cuts, cuts[1:])) == best[-1]
        assert all(at[b] - at[a] <= 12 for a, b in zip(cuts, cuts[1:]))
