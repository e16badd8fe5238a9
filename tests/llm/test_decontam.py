import random
import time

import numpy as np

from tidemark.llm import decontam


def brute_tiles(item, doc, least):
    """Greedy string tiling as first published: the longest matches of unmarked tokens, again and again."""
    a, b, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best, found = least, []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and a[i + n] and b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best:
                    found.append((i, j))
        if not found:
            return covered
        for i, j in found:
            if all(a[i : i + best]) and all(b[j : j + best]):
                a[i : i + best] = b[j : j + best] = [False] * best
                covered += best


def test_tiling_matches_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.randint(0, 3) for _ in range(rng.randint(3, 14))]
        doc = [rng.randint(0, 4) for _ in range(rng.randint(0, 30))]
        index = decontam.Index([("x", [str(t) for t in item])], 3)
        found = index.compare([str(t) for t in doc])
        assert (found[0][1] if found else 0) == brute_tiles(item, doc, 3)


def test_repetitive_texts_match_brute_force_and_long_ones_take_seconds():
    rng = random.Random(5)
    for _ in range(120):
        piece = [rng.randint(0, 2) for _ in range(rng.randint(1, 4))]
        item, doc = (piece * 9)[: rng.randint(3, 16)], (piece * 20)[: rng.randint(0, 34)]
        for x in (item, doc):
            for _ in range(rng.randint(0, 2)):
                if x:
                    x[rng.randrange(len(x))] = rng.randint(0, 3)
        index = decontam.Index([("x", [str(t) for t in item])], 3)
        found = index.compare([str(t) for t in doc])
        assert (found[0][1] if found else 0) == brute_tiles(item, doc, 3)
    for item, doc, covered in ((["a"] * 500, ["a"] * 200_000, 500), (["a", "b"] * 250, ["b", "a"] * 100_000, 500), (["a"] * 3_000, (["a"] * 40 + ["z"]) * 5_000, 3_000), (["a"] * 3_000, [x for n in range(5, 400) for x in ["a"] * (n % 77) + ["z"]], 3_000)):
        began = time.process_time()
        assert decontam.Index([("x", item), ("y", ["q"] * 9)], 5).compare(doc) == [("x", covered, len(item))]
        assert time.process_time() - began < 8


def test_reordered_passages_are_caught_and_clean_ones_left(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.randint(0, 900)}" for _ in range(n)]
    moved = noise(30) + words[20:] + noise(9) + words[:20] + noise(5)
    docs = spark.createDataFrame(
        [(1, " ".join(moved)), (2, " ".join(noise(200))), (3, None), (4, ""), (5, " ".join(noise(10) + words[:12])), (6, (" ".join(words) + " ") * 500), (6, "Short test.")], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(1, " ".join(words).upper()), (2, None), (3, ""), (4, "short TEST"), (1, " ".join(words))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in decontam.overlaps(docs, bench).collect())
    assert set(got) == {(1, 1, 1.0), (6, 1, 1.0), (6, 4, 1.0)}
    assert got == sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in decontam.overlaps(docs, bench, block_bytes=200).collect())
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(docs, bench).collect()) == [2, 3, 4, 5]
    assert decontam.overlaps(docs, bench.limit(0)).count() == 0 and decontam.overlaps(docs.limit(0), bench).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_whole_items_in_the_table(spark, docs, small):
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.overlaps(docs, bench).collect()}
    items = [(b["item_id"], " ".join(decontam.tokens(b["text"]))) for b in bench.collect()]
    for d in docs.collect():
        text = f" {' '.join(decontam.tokens(d['text']))} "
        for i, shown in items:
            assert (f" {shown} " not in text) or (d["doc_id"], i) in found


def test_rolling_hashes():
    codes = np.arange(20) % 7
    got = decontam.rolling(codes, 5)
    assert got[0] == got[7] and len(set(got[:7].tolist())) == 7 and len(decontam.rolling(codes[:4], 5)) == 0
