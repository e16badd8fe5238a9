import random

import numpy as np
import pytest
from tidemark.llm import simhash


def brute_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def near_prints(n, seed):
    """Chains and balls of fingerprints that differ by one to three bits."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice((1, 2, 30))):
            out.append(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    return sorted(set(out[:n]))


def linked(spark, prints, **options):
    frame = spark.createDataFrame([(simhash._signed(x),) for x in prints], "fp long")
    found = {r["node"] % 2**64: r["root"] for r in simhash.components(simhash.links(frame, **options)).collect()}
    groups = [found.get(x, f"alone {x}") for x in prints]
    want = brute_components(prints)
    assert len(set(zip(groups, want))) == len(set(groups)) == len(set(want))


def test_links_and_components_match_brute_force(spark):
    linked(spark, near_prints(500, 3))


def test_crowded_buckets_are_parted_until_they_are_small(spark):
    rng = random.Random(5)
    ball = {rng.getrandbits(64)}
    while len(ball) < 400:
        ball.add(rng.choice(sorted(ball)) ^ (1 << rng.randrange(12)) ^ (rng.random() < 0.3) << rng.randrange(64))
    linked(spark, sorted(ball), bucket_most=16)


def test_masks_within_masks_are_exact():
    rng = random.Random(6)
    for most in (1, 2):
        for m in simhash.masks(most):
            finer = simhash.masks(most, 2, m)
            assert all(k & m == m for k in finer) and max(64 - k.bit_count() for k in finer) <= (64 - m.bit_count() + 1) * most // (most + 2) + 1
            free = [b for b in range(64) if not m >> b & 1]
            for _ in range(60):
                x = sum(1 << b for b in rng.sample(free, most))
                assert any(not x & k for k in finer)


def test_pivots_discard_no_link():
    found = np.array(near_prints(300, 9), np.uint64)
    left, right = simhash.linked_pairs(found, simhash.pivot_table(found, simhash.pivots()))
    want = {(i, j) for j in range(len(found)) for i in range(j) if int(found[i] ^ found[j]).bit_count() <= 2}
    assert set(zip(left.tolist(), right.tolist())) == want


def test_masks_are_exact():
    rng = random.Random(2)
    for _ in range(500):
        x = 0
        for i in rng.sample(range(64), 2):
            x ^= 1 << i
        assert any(not x & m for m in simhash.masks())


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    for at_once in (simhash.EDGES_AT_ONCE, 40):
        got = [(r["node"], r["root"]) for r in simhash.components(edges, at_once).collect()]
        assert sorted(got) == sorted([*((i, 0) for i in range(301)), (1000, 1000), (1001, 1000)])


def test_near_duplicates(docs, odd):
    for frame in (docs, odd):
        rows = frame.collect()
        out = simhash.near_duplicates(frame).collect()
        assert len(out) == len(rows)
        prints = [simhash.fingerprint(r["text"]) for r in rows]
        assert sorted(((r["doc_id"], f"{p:016x}") for r, p in zip(rows, prints)), key=str) == sorted(((r["doc_id"], r["fingerprint"]) for r in out), key=str)
        roots = brute_components(prints)
        least = {}
        for r, k in zip(rows, roots):
            least[k] = min((x for x in (least.get(k), r["doc_id"]) if x is not None), default=None)
        assert sorted(((r["doc_id"], least[k]) for r, k in zip(rows, roots)), key=str) == sorted(((r["doc_id"], r["component_id"]) for r in out), key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(odd).columns == odd.columns


def alike(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / max(1, len(x | y))


def test_near_copies_are_grouped_and_others_left(spark):
    rng, rows, pairs = random.Random(11), [], 0
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    for k in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((25, 60, 200, 900)))]
        rows.append((len(rows), " ".join(words)))
        changed = list(words)
        for i in rng.sample(range(len(words)), max(1, len(words) // 60)):
            changed[i] = f"x{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(changed)))
        rows.append((len(rows), f"{' '.join(words[:12])} {passage} y{k} " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(40))))
    texts = dict(rows)
    head = {r["doc_id"]: r["head"] for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    missed = 0
    for k in range(0, len(rows), 3):
        near = alike(texts[k], texts[k + 1]) >= 0.8
        pairs += near
        missed += near and head[k] != head[k + 1]
        assert head[k + 2] == k + 2
        assert near or head[k + 1] == k + 1
    assert pairs > 50 and missed == 0


def test_short_near_copies_always_meet(spark):
    """14-word texts (ten shingles) that differ in the first or the last word, and others of 0.8 exactly."""
    rng, rows = random.Random(3), []
    for k in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(14)]
        other = [words[:13] + [f"x{k}"], [f"x{k}"] + words[1:], words[:12]][k % 3]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    texts = dict(rows)
    head = {r["doc_id"]: r["head"] for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert all(alike(texts[2 * k], texts[2 * k + 1]) >= 0.8 for k in range(150))
    assert [k for k in range(150) if head[2 * k + 1] != 2 * k] == []


def test_near_copies_among_templates_meet(spark, monkeypatch):
    """Texts that share 35 of 40 shingles each are 0.78 alike; twenty pairs among them share 36."""
    monkeypatch.setattr(simhash, "BLOCK", 32)
    template, texts = [f"t{k}" for k in range(39)], {}
    for k in range(100):
        texts[k] = " ".join([*template, *(f"o{k}_{i}" for i in range(5))])
        if k < 20:
            texts[1000 + k] = " ".join([*template, f"o{k}_0", *(f"p{k}_{i}" for i in range(4))])
    assert alike(texts[3], texts[4]) < 0.8 <= alike(texts[7], texts[1007])
    head = {r["doc_id"]: r["head"] for r in simhash.groups(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(3)).collect()}
    assert [k for k in range(20) if head[k] != head[1000 + k]] == []
    # by brute force: equal heads where links of either kind lead from text to text
    ids, prints = sorted(texts), {k: simhash.fingerprint(t) for k, t in texts.items()}
    want = {k: k for k in ids}
    for _ in ids:
        before = dict(want)
        for a in ids:
            for b in ids:
                if want[a] < want[b] and ((prints[a] ^ prints[b]).bit_count() <= 2 or alike(texts[a], texts[b]) >= 0.8):
                    want[b] = want[a]
        if want == before:
            break
    assert head == want


@pytest.mark.parametrize("sent", [simhash.SENT_IDS, 1])
def test_rows_without_or_with_repeated_ids_stay(spark, monkeypatch, sent):
    monkeypatch.setattr(simhash, "SENT_IDS", sent)
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    rows = [(None, text()) for _ in range(100)] + [(5, text()), (5, text()), (6, text())]
    rows += [(7, rows[0][1]), (8, rows[102][1]), (5, rows[100][1]), (None, rows[3][1]), (None, rows[3][1])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r["text"] for r in got) == sorted({t for _, t in rows})
    assert {(r["doc_id"], r["text"]) for r in got} >= {(7, rows[0][1]), (5, rows[100][1]), (5, rows[101][1]), (6, rows[102][1])}


def test_a_block_gives_a_spanning_forest():
    """Many alike texts in one block, with roots known for some: as many edges as they leave apart, and no link lost."""
    rng = np.random.default_rng(4)
    for shared in (38, 34, 0):
        sets = [np.unique(np.r_[np.arange(shared), rng.integers(100, 2**62, 40 - shared)]) for _ in range(60)]
        sets += [np.append(s[:-1], 2**62 + k) for k, s in enumerate(sets[:9])]
        root = np.arange(len(sets))
        root[20:24] = 20
        left, right = np.triu_indices(len(sets), 1)
        a, b = simhash.spanning(sets, root, left, right)
        alike = [len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) for i, j in zip(left, right)]
        known = [(20, k) for k in range(21, 24)]
        found = simhash._union(len(sets), [*a.tolist(), *(x for x, _ in known)], [*b.tolist(), *(y for _, y in known)])[0]
        want, used = simhash._union(len(sets), [*(x for x, _ in known), *left[alike].tolist()], [*(y for _, y in known), *right[alike].tolist()])
        assert found == want
        assert len(a) == len(used) - len(known) < len(sets) <= max(len(sets), sum(alike))
    assert [len(x) for x in simhash.spanning([], np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))] == [0, 0]


def test_crowded_blocks_lose_no_link(spark, monkeypatch):
    """The same as among templates, with every block joined in its task; blocks of a few texts and of few shingles."""
    monkeypatch.setattr(simhash, "PAIRS_A_TEXT", 0)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 900)
    test_near_copies_among_templates_meet(spark, monkeypatch)
