"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matches.

The items' seeds go to the tasks sorted, in blocks of a checked size, and each document's seeds are joined with them there.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_texts, map_texts

#: Tokens of the shortest match that is marked; also the length of the seeds.
MIN_MATCH = 5
#: Share of a test item's tokens that must be tiled.
MIN_COVERAGE = 0.5
#: UTF-8 bytes of test items that one pass over the documents compares with; more items take more passes.
BLOCK_BYTES = 8 << 20

_TOKEN = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(max(n - 1, 0), base % 2**64, np.uint64), out=out[1:])
    return out


class Rolling:
    """Karp-Rabin hashes, modulo 2**64, of the runs of any length of one sequence of codes."""

    def __init__(self, codes: np.ndarray):
        with np.errstate(over="ignore"):
            mixed = (codes + 2).astype(np.uint64) * _MIX
            mixed ^= mixed >> np.uint64(29)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * _powers(_BASE, len(codes)), dtype=np.uint64)])
        self.back = _powers(pow(_BASE, -1, 2**64), len(codes))

    def __call__(self, length: int) -> np.ndarray:
        n = len(self.back) - length + 1
        with np.errstate(over="ignore"):
            return (self.sums[length:] - self.sums[:n]) * self.back[:n] if n > 0 else np.zeros(0, np.uint64)


def rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of `length` codes."""
    return Rolling(codes)(length)


def _open_runs(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of the runs of `length` that are free throughout."""
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[:-length]) if length < len(taken) else np.zeros(0, np.int64)


def tile(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> int:
    """Tokens of item covered by greedy tiles: the longest common runs of unmarked tokens are marked first, in order of
    the item, then of the document, again and again until none of min_match tokens is left.

    The longest length is found by halving, with a Karp-Rabin comparison of all open runs at each step. After all of a
    length are marked only shorter ones are left, so there are about as many rounds as the root of the item's length.
    """
    free_item, free_doc, covered, most = np.ones(len(item), bool), doc >= 0, 0, min(len(item), len(doc))
    hashes = Rolling(item), Rolling(doc)

    def common(length: int):
        """Starts in the item and in the document whose runs' hashes lie in both, with those."""
        i, j = _open_runs(free_item, length), _open_runs(free_doc, length)
        hi, hj = hashes[0](length)[i], hashes[1](length)[j]
        known = np.unique(hi)
        if not len(known) or not len(j):
            return i[:0], hi[:0], j[:0], hj[:0]
        met = known[np.minimum(np.searchsorted(known, hj), len(known) - 1)] == hj
        own = np.isin(hi, hj[met])
        return i[own], hi[own], j[met], hj[met]

    while most >= min_match and len(common(min_match)[0]):
        low, high = min_match, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
        i, hi, j, hj = common(low)
        order = np.argsort(hj, kind="stable")
        classes, first = np.unique(hj[order], return_index=True)
        at = {int(h): k for k, h in enumerate(classes)}
        nexts, ends = first.tolist(), [*first[1:].tolist(), len(order)]
        j, upto = j[order].tolist(), -1
        for a, h in zip(i.tolist(), hi.tolist()):
            if a < upto:
                continue
            k = at[h]
            while nexts[k] < ends[k]:  # what is not free now never will be
                b = j[nexts[k]]
                if not free_doc[b : b + low].all():
                    nexts[k] += 1
                    continue
                if np.array_equal(item[a : a + low], doc[b : b + low]):
                    free_item[a : a + low] = False
                    free_doc[b : b + low] = False
                    covered, upto = covered + low, a + low
                break
        most = low - 1
    return covered


class Index:
    """Seeds of a block of test items: the sorted hashes of their runs of MIN_MATCH tokens, each with the items that have it."""

    def __init__(self, items: list[tuple[object, list[str]]], min_match: int):
        self.min_match, self.vocabulary = min_match, {}
        self.items = [(item_id, np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)) for item_id, words in items]
        seeds = [rolling(codes, min_match) for _, codes in self.items]
        owner = np.repeat(np.arange(len(seeds)), [len(x) for x in seeds])
        self.hashes, place = np.unique(np.concatenate(seeds) if seeds else np.zeros(0, np.uint64), return_inverse=True)
        pairs = np.unique(place * max(len(seeds), 1) + owner)
        self.owners = pairs % max(len(seeds), 1)
        self.first = np.searchsorted(pairs // max(len(seeds), 1), np.arange(len(self.hashes) + 1))
        self.places = np.split(place, np.cumsum([len(x) for x in seeds])[:-1]) if seeds else []
        self.marked = np.zeros((2, len(self.hashes)), bool)  # clean between calls

    def compare(self, words: list[str], min_coverage: float = 0.0) -> list[tuple[object, int, int]]:
        """(item, tiled tokens, tokens) of each item that shares a seed with the document and of whose tokens the shared
        seeds cover min_coverage; no tile lies outside of them."""
        get, size = self.vocabulary.get, self.min_match
        doc = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.r_[0, np.cumsum(doc >= 0)]
        at = np.flatnonzero(known[size:] - known[:-size] == size) if len(doc) >= size else []
        if not len(at) or not len(self.hashes):
            return []
        found = rolling(doc, size)[at]
        place = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[place] == found
        at, place = at[hit], place[hit]
        shared = np.unique(place)
        owners = np.unique(np.concatenate([self.owners[self.first[p] : self.first[p + 1]] for p in shared.tolist()])) if len(shared) else []
        out, (mine, theirs) = [], self.marked
        theirs[shared] = True
        for k in owners:
            item_id, codes = self.items[k]
            seeds = self.places[k]
            if _spread(np.flatnonzero(theirs[seeds]), size, len(codes)).sum() >= min_coverage * len(codes):
                mine[seeds] = True
                inside = np.flatnonzero(_spread(at[mine[place]], size, len(doc)))
                mine[seeds] = False
                breaks = np.flatnonzero(np.diff(inside) > 1) + 1
                out.append((item_id, tile(codes, np.insert(doc[inside], breaks, -1), size), len(codes)))
        theirs[shared] = False
        return out


def _spread(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of `length` from one of the starts on."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:n]) > 0


def by_length(items: list[tuple[object, str]], min_match: int) -> list[Index]:
    """Indexes of the items; those of fewer than min_match tokens have shorter seeds."""
    own: dict[int, list] = defaultdict(list)
    for item_id, text in items:
        if words := tokens(text):
            own[min(min_match, len(words))].append((item_id, words))
    return [Index(part, n) for n, part in sorted(own.items())]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The test items in blocks of about block_bytes, each small enough to be sent to all tasks."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted({(r["item_id"], r["text"]) for r in part.collect()}, key=repr)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, tiled, item_tokens, coverage of each document and test item whose tiled share reaches min_coverage.

    Tokens are runs of letters, digits and underscores, lower-cased; order of the tiles does not matter, so reordered
    passages count. Items of under min_match tokens match where the document holds all of them in a row. Null and empty
    texts on either side match nothing; repeated items count once, repeated documents each; texts are compared whole.
    The items go to the tasks in blocks of a checked size; a larger benchmark takes more passes over the documents.
    """
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}"
    schema = f"{kinds}, tiled long, item_tokens long, coverage double"

    def against(items: list) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def make():
            indexes = by_length(sent.value, min_match)

            def step(ids, texts):
                out: list[list] = [[], [], [], [], []]
                for doc_id, text in zip(ids, texts):
                    words = tokens(text)
                    for index in indexes:
                        for item, tiled, n in index.compare(words, min_coverage):
                            if tiled >= min_coverage * n:
                                for column, v in zip(out, (doc_id, item, tiled, n, tiled / n)):
                                    column.append(v)
                return out

            return step

        return map_texts(docs, ["doc_id", "text"], schema, make)

    found = [against(items) for items in blocks(benchmark, block_bytes)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that tile no test item, with all their columns. A row is judged by its own text, in one pass a
    block and without a join: the documents stream through the tasks and the contaminated do not come out. Null and empty
    texts hold nothing and stay; repeated rows are judged each; an empty benchmark takes nothing out."""
    kept = docs
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def make(sent=sent):
            indexes = by_length(sent.value, MIN_MATCH)

            def clean(text: str | None) -> bool:
                words = tokens(text)
                return not any(tiled >= MIN_COVERAGE * n for index in indexes for _, tiled, n in index.compare(words, MIN_COVERAGE))

            return lambda texts: list(map(clean, texts))

        kept = filter_texts(kept, make)
    return kept
