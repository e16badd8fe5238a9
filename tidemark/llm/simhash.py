"""SimHash near-duplicates: pivot distance tables over fingerprints, exact links and components."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.cluster import ship
from tidemark.llm.common import checkpointed, fresh, map_texts, uneven_join

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Reference fingerprints of a pivot table.
PIVOTS = 24
#: Fingerprints of a bucket whose pairs are looked at together; a larger bucket is parted by finer bands.
BUCKET_MOST = 256
#: Edges that one task joins at once.
EDGES_AT_ONCE = 1 << 20


# --- fingerprints -------------------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text; 0 without words."""
    return fingerprint_of(words_of(text), words_in_shingle)


def fingerprint_of(words: list[bytes], words_in_shingle: int = SHINGLE_WORDS) -> int:
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_in_shingle))))
    votes, n = np.zeros(64, np.int64), 0
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    while len(part := np.fromiter(itertools.islice(hashes, 1 << 16), np.uint64)):
        votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of each row."""

    def make():
        def step(ids, texts):
            return [ids, np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

        return step

    return map_texts(docs, ["doc_id", "text"], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long", make)


# --- links --------------------------------------------------------------------------------------------------------


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints by a rule: the splitmix64 sequence."""
    out, state = [], 0
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) % 2**64
        z = state
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        out.append(z ^ (z >> 31))
    return np.array(out, np.uint64)


def pivot_table(found: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each reference."""
    return np.bitwise_count(found[:, None] ^ references[None, :]).astype(np.int8)


def linked_pairs(found: np.ndarray, table: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within max_bits. A pair is discarded as soon as one coordinate of the table differs by more, which
    no pair within max_bits can do (triangle inequality); the survivors' own distances are verified."""
    left, right = np.triu_indices(len(found), 1)
    for k in range(table.shape[1]):
        near = np.abs(table[left, k] - table[right, k]) <= max_bits
        left, right = left[near], right[near]
    near = np.bitwise_count(found[left] ^ found[right]) <= max_bits
    return left[near], right[near]


def _parted(bits: list[int], n: int) -> list[int]:
    """Masks of n bands that the bits, by number, fall into."""
    edges = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in itertools.pairwise(edges)]


def masks(max_bits: int = MAX_BITS, kept: int = 3, within: int = 0) -> list[int]:
    """Bit masks such that two fingerprints within max_bits that agree under `within` agree under at least one of them:
    the other bits fall into max_bits + kept bands, of which max_bits bits touch max_bits at most (pigeonhole)."""
    bands = _parted([b for b in range(64) if not within >> b & 1], max_bits + kept)
    return [within | sum(c) for c in itertools.combinations(bands, kept)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _union(size: int, left: list[int], right: list[int]) -> tuple[list[int], list[int]]:
    """The smallest member of each member's set after the unions, and the indices of the pairs that joined two sets."""
    parent, used = list(range(size)), []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for k, (i, j) in enumerate(zip(left, right)):
        if (x := root(i)) != (y := root(j)):
            parent[max(x, y)] = min(x, y)
            used.append(k)
    return [root(i) for i in range(size)], used


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_most: int = BUCKET_MOST) -> DataFrame:
    """Pairs (a, b) of different fingerprints within max_bits (1 or 2) that connect all such pairs' components.

    distinct: one column fp without repeats. Buckets of fingerprints that agree under a mask bring candidates together;
    within each the pivot table discards pairs and survivors are verified; a bucket gives the edges of a spanning
    forest, so copies of one text never become all pairs. A bucket of over bucket_most members is dealt out again under
    masks that take half of its free bits, until no bucket is too large: one with b free bits has 2**b members at most.
    """
    fp, references = F.col("fp"), pivots()
    ship(distinct.sparkSession)

    def forest(groups):
        for frame in groups:
            found = frame["fp"].to_numpy().view(np.uint64)
            key = frame[["mask", "bits"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            table, a, b = pivot_table(found, references), [], []
            for lo, hi in zip(starts, [*starts[1:], len(found)]):
                left, right = linked_pairs(found[lo:hi], table[lo:hi], max_bits)
                used = _union(hi - lo, left.tolist(), right.tolist())[1]
                a.append(found[lo + left[used]]), b.append(found[lo + right[used]])
            yield pd.DataFrame({k: np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64) for k, x in (("a", a), ("b", b))})

    def whole_groups(frames):
        """Whole buckets, some at a time: the rows come sorted, and a bucket has at most bucket_most of them."""
        rest = None
        for frame in (f for f in frames if len(f)):
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (rest["mask"] == rest["mask"].iloc[-1]) & (rest["bits"] == rest["bits"].iloc[-1])
            if len(done := rest[~last]):
                yield done.reset_index(drop=True)
            rest = rest[last].reset_index(drop=True)
        if rest is not None and len(rest):
            yield rest

    level = masks(max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in level))).alias("mask"))
    out = None
    while True:
        keyed = keyed.select("fp", "mask", fp.bitwiseAND(F.col("mask")).alias("bits"))
        counted = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = checkpointed(keyed.join(counted, ["mask", "bits"]))
        small = shared.where(F.col("n") <= bucket_most).select("fp", "mask", "bits")
        paired = small.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp").mapInPandas(lambda frames: forest(whole_groups(frames)), "a long, b long")
        out = paired if out is None else out.unionByName(paired)
        crowded = shared.where(F.col("n") > bucket_most)
        if crowded.isEmpty():
            return out.distinct()
        finer = {m: masks(max_bits, 2, m) for m in level}
        parts = F.create_map(*(x for m, own in finer.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(k)) for k in own)))))
        keyed = crowded.select("fp", F.explode(parts[F.col("mask")]).alias("mask")).distinct()
        level = list(dict.fromkeys(k for own in finer.values() for k in own))


def _stars(edges: DataFrame) -> DataFrame:
    """node and root of the nodes of each partition's edges, as far as those edges reach; every node with its partition's smallest."""

    def run(frames):
        if parts := [f for f in frames if len(f)]:
            a, b = (np.concatenate([f[c].to_numpy() for f in parts]) for c in "ab")
            nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            roots = _union(len(nodes), place[: len(a)].tolist(), place[len(a) :].tolist())[0]
            yield pd.DataFrame({"node": nodes, "root": nodes[roots]})

    ship(edges.sparkSession)
    return edges.mapInPandas(run, "node long, root long")


def components(edges: DataFrame, at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """node and root (the smallest node reachable) for each node of the edges (a, b).

    Each task first replaces some at_once edges by the stars of their own components; if those are all, that is the
    result. Of more, alternating large-star and small-star rounds link nodes to smaller neighbours until every component
    is a star. Rounds are cut by checkpoints in the shared folder; nothing but a count and a digest of the edges reaches
    the driver. Minima are summed up before they are dealt out; a hub's rows in a join are split by adaptive execution.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = checkpointed(edges.where("a <> b"))
    parts = -(-edges.count() // at_once)
    if parts <= 1:
        return checkpointed(_stars(edges.coalesce(1)))
    stars = _stars(edges.repartition(parts)).where("node <> root")
    edges = checkpointed(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    seen = digest(edges)
    while True:
        around = both(edges)
        large = around.join(smallest(around), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every node points only downwards now; link its lower neighbours and itself to the lowest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after = checkpointed(small)
        edges, before, seen = after, seen, digest(after)
        if seen == before:
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links, itself included).

    Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows and repeated ids
    stay, each with its text's fingerprint; null ids stay and are never a component's id unless it has no other. An
    empty table gives no rows; other columns of docs are not looked at. Texts are hashed whole.
    """
    held = checkpointed(fingerprints(docs.select("doc_id", "text")))
    owners = checkpointed(held.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n")))
    member = components(links(owners.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    rooted = owners.join(member, "fp", "left").select("fp", "owner", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("owner").alias("component_id"))
    named = checkpointed(rooted.join(least, "root").select("fp", "component_id", "n"))
    return uneven_join(held, named, "fp", "n").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


# --- near copies by similarity ----------------------------------------------------------------------------------------

SIMILAR_WORDS, MIN_SIMILARITY = 5, 0.8
#: Cells that a text's shingles are counted in. Two texts' counts differ by no more in all than their shingles do.
CELLS = 256
#: One text in so many tells which shingles are common, from so many of its texts on; at most COMMON_SENT of them are
#: sent to the tasks. They come last in the order of shingles, which changes how many candidates there are, not the links.
SAMPLED, COMMON_FROM, COMMON_SENT = 16, 4, 500_000
#: Texts of one bucket that are compared in one go.
BLOCK = 512
#: Candidate pairs of a block for each of its texts that are handed on as pairs; a block of more is joined in its task.
PAIRS_A_TEXT = 16
#: Shingles of a bucket's texts that one side of a comparison has, about as many; a bucket of long texts has more blocks.
BLOCK_SHINGLES = 1 << 21
#: Ids that are sent to all tasks to pick texts out; more are joined.
SENT_IDS = 2_000_000
#: Pairs that a task looks at together.
PAIRS_AT_ONCE = 1 << 18
#: Words of the bitmap by which keys of one text are left out before they are dealt out: 16 MB at most.
FILTER_WORDS = 1 << 20


def shingle_hashes(text: str | None, size: int = SIMILAR_WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles of a whole text, lower-cased; a shorter text is one shingle."""
    return shingles_of(words_of(text), size)


def shingles_of(words: list[bytes], size: int = SIMILAR_WORDS) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words, itertools.repeat(SEED)), np.uint64, len(words))
    size, n = min(size, len(own)), max(len(own) - size + 1, 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):  # a polynomial of the words' hashes
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n]
    return np.unique(out)


def prefix(h: np.ndarray, common: np.ndarray, ranks: np.ndarray, min_similarity: float = MIN_SIMILARITY) -> np.ndarray:
    """The first shingles in an order that holds for all texts (rank of commonness, then hash), so many that two texts
    of min_similarity have one of them in common: such texts share min_similarity of either's shingles at least."""
    if not len(h):
        return h
    rank = np.zeros(len(h), np.int64)
    if len(common):
        place = np.minimum(np.searchsorted(common, h), len(common) - 1)
        rank = np.where(common[place] == h, ranks[place], 0)
    return h[np.argsort(rank, kind="stable")[: len(h) - int(np.ceil(min_similarity * len(h) - 1e-9)) + 1]]


def cells(h: np.ndarray) -> bytes:
    return np.minimum(np.bincount((h >> np.uint64(56)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes()


def may_be_similar(na: np.ndarray, nb: np.ndarray, pa: np.ndarray, pb: np.ndarray, min_similarity: float = MIN_SIMILARITY) -> np.ndarray:
    """Whether texts of na and nb shingles whose first common one is pa-th and pb-th can be similar."""
    return np.minimum(na - pa, nb - pb) >= least_common(na, nb, min_similarity)


def least_common(na: np.ndarray, nb: np.ndarray, min_similarity: float = MIN_SIMILARITY) -> np.ndarray:
    """Shingles that two texts of min_similarity have in common at least."""
    return np.ceil(np.maximum(min_similarity / (1 + min_similarity) * (na + nb), min_similarity * np.maximum(na, nb)) - 1e-9).astype(np.int64)


def cells_near(na: np.ndarray, nb: np.ndarray, a: np.ndarray, b: np.ndarray, min_similarity: float = MIN_SIMILARITY) -> np.ndarray:
    """Whether cell counts a and b (a row a pair) differ by no more than similar texts' shingles can."""
    return np.abs(a.astype(np.int16) - b).sum(axis=1, dtype=np.int64) <= na + nb - 2 * least_common(na, nb, min_similarity)


def _cell_rows(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, CELLS)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles common in a sample of the texts, and their ranks from 1 on."""

    def make():
        def step(texts):
            found = [shingle_hashes(t) for t in texts]
            return [np.concatenate(found).view(np.int64)]

        return step

    sample = docs.where(F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % SAMPLED == 0)
    counted = checkpointed(map_texts(sample, ["text"], "s long", make).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_FROM))
    level = F.floor(F.log2("n") * 4)
    total, least = 0, None
    for b in counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("shingles"), F.min("n").alias("least")).orderBy(F.desc("level")).collect():
        total += b["shingles"]
        if total > COMMON_SENT:
            break
        least = b["least"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counted.where(F.col("n") >= least).toArrow()
    found, n = rows["s"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(found)
    return found[order], n[order]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, mark, tid (what the text is, but for case and white space), fp, n (shingles), cells and prefix of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))

    def make():
        common, ranks = sent.value

        def one(text):
            words = words_of(text)
            h = shingles_of(words)
            return xxhash.xxh64_intdigest(b" ".join(words), SEED), fingerprint_of(words), len(h), cells(h), prefix(h, common, ranks)

        def step(ids, marks, texts):
            tids, prints, n, counts, firsts = zip(*map(one, texts))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32()), pa.array(np.concatenate(firsts).view(np.int64)))
            return [ids, marks, np.array(tids, np.uint64).view(np.int64), np.array(prints, np.uint64).view(np.int64), n, counts, lists]

        return step

    return map_texts(docs, ["doc_id", "mark", "text"], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark long, tid long, fp long, n long, cells binary, prefix array<long>", make)


def shingles_by_tid(docs: DataFrame, texts: DataFrame, tids: DataFrame) -> DataFrame:
    """tid and s, the sorted hashes of its whole text's shingles, of some texts. docs: mark, text; texts: tid, mark."""
    ids = checkpointed(tids.join(texts.select("tid", "mark"), "tid"))
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)

    def make():
        def step(tids, found):
            return [tids, [shingle_hashes(t).view(np.int64).tolist() for t in found]]

        return step

    wanted = docs.join(ids, "mark").groupBy("tid").agg(F.min("text").alias("text"))
    return map_texts(wanted, ["tid", "text"], "tid long, s array<long>", make)


def similar_of(docs: DataFrame, texts: DataFrame, near: DataFrame, min_similarity: float) -> DataFrame:
    """The pairs (a, b) of near whose whole texts' shingles are min_similarity alike. docs: mark, text; texts: tid, mark."""
    near = checkpointed(near)
    tids = near.select(F.col("a").alias("tid")).union(near.select(F.col("b").alias("tid"))).distinct()
    sets = checkpointed(shingles_by_tid(docs, texts, tids))
    met = near.join(sets.select(F.col("tid").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("tid").alias("b"), F.col("s").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return checkpointed(met.where(common >= min_similarity * (F.size("x") + F.size("y") - common)).select("a", "b"))


def spanning(sets: list[np.ndarray], root: np.ndarray, left: np.ndarray, right: np.ndarray, min_similarity: float = MIN_SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of places (left, right) those that join components: similar ones, by their whole sets, whose ends no roots
    and no pairs before connect. There are fewer of them than sets, however many pairs there are."""
    parent, out = {r: r for r in root.tolist()}, ([], [])

    def top(r):
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    used = np.unique(np.concatenate([left, right]))
    ids = np.unique(np.concatenate([np.zeros(0, np.int64), *(sets[k] for k in used)]), return_inverse=True)[1]
    size = np.array([len(sets[k]) for k in used], np.int64)
    end = np.cumsum(size)
    place = {k: i for i, k in enumerate(used.tolist())}
    mark = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    starts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]][: len(left)])
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(left)]):
        k = int(left[lo])
        i, own = place[k], top(int(root[k]))
        others = [j for j in right[lo:hi].tolist() if top(int(root[j])) != own]
        if not others:
            continue
        at = np.array([place[j] for j in others])
        mark[ids[end[i] - size[i] : end[i]]] = True
        common = np.add.reduceat(mark[np.concatenate([ids[end[j] - size[j] : end[j]] for j in at])], np.cumsum(size[at]) - size[at], dtype=np.int64)
        mark[ids[end[i] - size[i] : end[i]]] = False
        for j in np.flatnonzero(common >= min_similarity * (size[i] + size[at] - common)).tolist():
            x, y = top(int(root[k])), top(int(root[others[j]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out[0].append(k), out[1].append(others[j])
    return np.array(out[0], np.int64), np.array(out[1], np.int64)


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the keys that occur, summed up by Spark: FILTER_WORDS words of 64 at most. A bit that is not set tells that a key is none of them."""
    n = 1 << max(10, min(FILTER_WORDS, keys.count() // 4).bit_length())
    word, bit = F.col("key").bitwiseAND(F.lit(n - 1)), F.shiftrightunsigned("key", 40).bitwiseAND(F.lit(63))
    rows = keys.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))).alias("bits")).toArrow()
    out = np.zeros(n, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def bucketed(texts: DataFrame) -> DataFrame:
    """tid, n, pos, key: the texts' prefixes taken apart, without most of the keys that only one text has."""
    counted = texts.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = checkpointed(counted.select("key"))
    sent = texts.sparkSession.sparkContext.broadcast(bitmap(shared))

    def run(batches):
        bits = sent.value
        for batch in batches:
            n, first = batch.num_rows, batch.column("prefix")
            length, key = first.value_lengths().to_numpy(), first.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(n), length)
            pos = np.arange(len(key)) - np.repeat(np.cumsum(length) - length, length)
            at = np.flatnonzero(bits[key & np.uint64(len(bits) - 1)] >> (key >> np.uint64(40) & np.uint64(63)) & np.uint64(1))
            tid, counts = batch.column("tid").take(pa.array(row[at])), batch.column("n").take(pa.array(row[at]))
            yield pa.RecordBatch.from_arrays([tid, counts, pa.array(pos[at].astype(np.int32)), pa.array(key[at].view(np.int64))], names=["tid", "n", "pos", "key"])

    met = texts.select("tid", "n", "prefix").mapInArrow(run, "tid long, n long, pos int, key long")
    return met.join(shared, "key")


def similar_links(docs: DataFrame, texts: DataFrame, linked: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Pairs (a, b) of tids: linked, and others whose five-word shingles are at least min_similarity alike (Jaccard),
    that connect all such pairs' components.

    docs: mark, text; texts: tid, mark, n, cells, prefix of each different text; linked: pairs known already. Texts meet
    in buckets by the shingles of their prefixes, which similar texts always do; buckets of the same texts, as the
    shingles of a passage that they share, are one, in which each text has its first position. First each is compared
    with the least tid of its bucket, so that many near copies become one component by as many pairs as texts; then, in
    buckets that still hold several components, all pairs between components, in blocks. Counts of shingles in cells
    discard pairs that cannot be similar, never others; the survivors' shingles are compared exactly, from their whole
    texts. A block with more such pairs
    than PAIRS_A_TEXT for each of its texts gives the edges of a spanning forest, found in its task, and never its pairs.
    """
    ship(docs.sparkSession)
    met = checkpointed(bucketed(texts))
    own = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "tid"))
    by_key = met.groupBy("key").agg(F.count(F.lit(1)).alias("m"), own(1).alias("s1"), own(2).alias("s2"))
    members = checkpointed(met.join(by_key, "key").groupBy("s1", "s2", "tid").agg(F.min("pos").alias("pos"), F.first("n").alias("n"), F.first("m").alias("m")))
    heads = members.groupBy("s1", "s2").agg(F.min(F.struct("tid", "n", "pos")).alias("first"))

    most, bound = F.greatest("na", "nb"), F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    named = members.join(heads, ["s1", "s2"]).select(
        F.col("tid").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("first.tid").alias("b"), F.col("first.n").alias("nb"), F.col("first.pos").alias("pb")
    )
    may = bound >= F.greatest(most * min_similarity, (F.col("na") + F.col("nb")) * (min_similarity / (1 + min_similarity))) - 1e-9
    pairs = named.where((F.col("a") != F.col("b")) & may).select("a", "b", "na", "nb").distinct()

    def kept(frames):
        for f in frames:
            for at in range(0, len(f), 4096):
                g = f.iloc[at : at + 4096]
                yield g.loc[cells_near(g["na"].to_numpy(), g["nb"].to_numpy(), _cell_rows(g["ca"]), _cell_rows(g["cb"]), min_similarity), ["a", "b"]]

    counts = texts.select("tid", "cells")
    with_cells = pairs.join(counts.select(F.col("tid").alias("a"), F.col("cells").alias("ca")), "a").join(counts.select(F.col("tid").alias("b"), F.col("cells").alias("cb")), "b")
    stars = linked.unionByName(similar_of(docs, texts, with_cells.mapInPandas(kept, "a long, b long"), min_similarity))
    root = components(stars).select(F.col("node").alias("tid"), "root")

    rooted = checkpointed(members.join(root, "tid", "left").select("s1", "s2", "m", "tid", "n", "pos", F.coalesce("root", "tid").alias("root")))
    several = rooted.groupBy("s1", "s2").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum("n").alias("all")).where("low < high").select("s1", "s2", "all")
    blocks = F.least(F.col("m"), F.ceil(F.greatest(F.col("m") / BLOCK, F.col("all") / BLOCK_SHINGLES))).cast("int")
    left = rooted.join(several, ["s1", "s2"]).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = left.select("s1", "s2", "tid", "n", "pos", "root", "own", other).select("s1", "s2", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "tid", "n", "pos", "root").join(counts, "tid")
    block = ["s1", "s2", "lo", "hi"]

    def candidates(frame):
        """Places of pairs of a frame of whole blocks, some at a time, that can be similar and lie in different components."""
        key, own = frame[block].to_numpy(), frame["own"].to_numpy()
        n, pos, root = (frame[c].to_numpy() for c in ("n", "pos", "root"))
        counted = _cell_rows(frame["cells"])
        coarse = counted.reshape(len(counted), 16, -1).sum(axis=2, dtype=np.int16)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        lefts, rights, held = [], [], 0

        def looked_at():
            left, right = np.concatenate(lefts), np.concatenate(rights)
            able = (root[left] != root[right]) & may_be_similar(n[left], n[right], pos[left], pos[right], min_similarity)
            left, right = left[able], right[able]
            for cells_of, at_once in ((coarse, 1 << 15), (counted, 1 << 12)):  # sums of cells differ by no more than the cells
                near = [np.zeros(0, bool)]
                for at in range(0, len(left), at_once):
                    x, y = left[at : at + at_once], right[at : at + at_once]
                    near.append(cells_near(n[x], n[y], cells_of[x], cells_of[y], min_similarity))
                near = np.concatenate(near)
                left, right = left[near], right[near]
            return left, right

        for lo, hi in zip(starts, [*starts[1:], len(frame)]):
            if key[lo, 2] == key[lo, 3]:
                left, right = np.triu_indices(hi - lo, 1)
            else:
                at = own[lo:hi] == key[lo, 2]
                left, right = (x.reshape(-1) for x in np.meshgrid(np.flatnonzero(at), np.flatnonzero(~at)))
            lefts.append(left + lo), rights.append(right + lo)
            held += len(left)
            if held > PAIRS_AT_ONCE:
                yield looked_at()
                lefts, rights, held = [], [], 0
        if lefts:
            yield looked_at()

    def whole_blocks(frames):
        rest = None
        for frame in (f for f in frames if len(f)):
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (rest[block] == rest[block].iloc[-1]).all(axis=1)
            if len(done := rest[~last]):
                yield done.reset_index(drop=True)
            rest = rest[last].reset_index(drop=True)
        if rest is not None and len(rest):
            yield rest

    most = PAIRS_A_TEXT

    def with_candidates(frames):
        """Pairs (as tid and root) of blocks that have few for their texts, and of the other blocks the texts that have any."""
        for frame in whole_blocks(frames):
            key, tid, some, pairs = frame[block].to_numpy(), frame["tid"].to_numpy(), np.zeros(len(frame), bool), []
            number = np.cumsum(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]) - 1
            members = np.bincount(number)
            for left, right in candidates(frame):
                many = (np.bincount(number[left], minlength=len(members)) > most * members)[number[left]]
                some[left[many]] = some[right[many]] = True
                pairs.append(np.stack([tid[left[~many]], tid[right[~many]]]))
            yield frame[some].assign(paired=False)
            two = np.unique(np.sort(np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1), axis=0), axis=1)
            yield pd.DataFrame({c: two[1] if c == "tid" else two[0] if c == "root" else True if c == "paired" else b"" if c == "cells" else 0 for c in columns}, index=range(two.shape[1]))

    def forest(frames):
        for frame in whole_blocks(frames):
            tid, a, b = frame["tid"].to_numpy(), [], []
            for left, right in candidates(frame):
                x, y = spanning(list(frame["s"]), frame["root"].to_numpy(), left, right, min_similarity)
                a.append(np.maximum(tid[x], tid[y])), b.append(np.minimum(tid[x], tid[y]))
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    row = "s1 long, s2 long, lo int, hi int, own int, tid long, n long, pos int, root long, cells binary, paired boolean"
    in_blocks = lambda rows: rows.repartition(*block).sortWithinPartitions(*block)
    columns = [c.split()[0] for c in row.split(", ")]
    looked = checkpointed(in_blocks(dealt).select(*columns[:-1]).mapInPandas(with_candidates, row))
    pairs, some = looked.where("paired").select(F.col("tid").alias("a"), F.col("root").alias("b")).distinct(), looked.where("not paired")
    sets = shingles_by_tid(docs, texts, some.select("tid").distinct())
    found = in_blocks(some.join(sets, "tid")).mapInPandas(forest, "a long, b long").distinct()
    return stars.unionByName(checkpointed(found)).unionByName(similar_of(docs, texts, pairs, min_similarity))


def members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, mark and tid of each row; and of each different text: tid, root (equal for the texts of a group), n_rows, and owner,
    the row with the least id (null ids last): whether it is null, the id, and mark, a hash of the row's exact text."""
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    held = checkpointed(sketches(marked))
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("owner")
    grouped = held.groupBy("tid").agg(owner, F.count(F.lit(1)).alias("n_rows"), *(F.first(c).alias(c) for c in ("fp", "n", "cells", "prefix")))
    texts = checkpointed(grouped.withColumn("mark", F.col("owner.mark")))
    by_print = texts.groupBy("fp").agg(F.min("tid").alias("b"))
    same = texts.join(by_print, "fp").where("tid <> b").select(F.col("tid").alias("a"), "b")
    linked = links(by_print.select("fp"))
    named = lambda side: by_print.select(F.col("fp").alias(side), F.col("b").alias(f"tid_{side}"))
    across = linked.join(named("a"), "a").join(named("b"), "b").select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
    known = checkpointed(same.unionByName(across))
    alike = similar_links(marked.select("mark", "text"), texts, known)
    member = components(alike).select(F.col("node").alias("tid"), "root")
    return held.select("doc_id", "mark", "tid"), texts.join(member, "tid", "left").select("tid", "owner", "n_rows", F.coalesce("root", "tid").alias("root"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id and head, the smallest doc_id of the row's group, of each row. Groups are the components over equal texts,
    fingerprints within MAX_BITS, and five-word shingles that are MIN_SIMILARITY alike. Null, empty and blank texts are
    equal texts; a null id is a head only where a group has no other; no rows give no rows."""
    held, rooted = members(docs)
    heads = rooted.groupBy("root").agg(F.min("owner").alias("owner")).select("root", F.col("owner.doc_id").alias("head"))
    return uneven_join(held, checkpointed(rooted.join(heads, "root").select("tid", "head", "n_rows")), "tid", "n_rows").select("doc_id", "head")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, the one with the smallest id (a null id last), with all its columns whatever their names.

    Rows are told apart by id and exact text, so rows of different groups that repeat an id, or have none, stay; of
    wholly equal ones one stays. Null, empty and blank texts form one group. No rows give no rows.
    """
    k1, k2 = fresh(docs, "key_1"), fresh(docs, "key_2")
    told = lambda i, mark: [F.xxhash64(F.lit(seed), i.isNull(), i, mark).alias(c) for seed, c in ((1, k1), (2, k2))]
    first = members(docs)[1].groupBy("root").agg(F.min("owner").alias("owner"))
    kept = first.select(*told(F.col("owner.doc_id"), F.col("owner.mark")))
    keyed = docs.select("*", *told(F.col("doc_id"), F.xxhash64("text")))
    return keyed.dropDuplicates([k1, k2]).join(kept, [k1, k2], "left_semi").select(*docs.columns)
