"""Language-model scores: word unigrams, and a probabilistic suffix tree over the bytes of texts.

A text is a blank, its words, each ended by a blank, and then an end mark. The tree predicts each byte but the first blank from
the longest kept context before it, which may reach over any number of words back to the text's start. It is learned from
the whole training texts, which are read twice for several lengths: frequent contexts are sought, then counted.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROWS_AT_ONCE, checkpointed, id_remainder, ship

#: A context is counted on if it occurs so often: N ** (2 / 3) / CONTEXT_SHARE of N symbols. A length then has no more than
#: CONTEXT_SHARE * N ** (1 / 3) contexts: what is learned grows with the corpus, but slowly enough to be sent to tasks.
CONTEXT_SHARE = 100
LEAST_COUNT = 8
#: A context is kept if its next-symbol counts diverge from its suffix's distribution by so many nats in all. One that cannot
#: lose as many by any refinement is not made longer.
MIN_DIVERGENCE = 12.0
#: Bytes of the tree that a task may be sent; the check that the bound above holds.
MOST_TREE_BYTES = 1 << 29
#: Words whose counts are sent to every task; the others are looked up by a join.
SENT_WORDS = 60_000
#: Symbols whose words a task gathers before it hands on their counts.
HELD_SYMBOLS = 1 << 25
#: The end token among words; no word contains a blank. Its byte is none of UTF-8's.
END_WORD, END_BYTE = b" ", b"\xff"

#: What stands between texts; none of UTF-8's bytes either.
OUTSIDE = b"\xfe"
#: Symbols that are looked at at once, that are sorted at once where contexts are sought and where they are counted, and whose
#: frequent contexts are sought together.
BLOCK, SORTED_AT_ONCE, COUNTED_AT_ONCE, CHUNK = 1 << 16, 1 << 23, 1 << 22, 1 << 22
#: Places whose contexts are looked up at once where they are sought.
SOUGHT_AT_ONCE = 1 << 17
#: Symbols that are scored at once, and the lengths of contexts that are followed by an automaton.
SCORED_AT_ONCE, NEAR_LENGTHS = 1 << 20, 16
#: Symbols of a stretch that is followed beside others, and entries of an automaton's table, of four bytes, at most. Larger ones
#: are not made: the contexts beyond are walked to, or counted by sorting.
STRETCH, MOST_STEPS = 1 << 8, 1 << 24
#: Bytes of contexts that are taken at once, level by level, in the first two readings; later levels have four.
FIRST_WIDTHS = [7, 4, 4]
#: Contexts that two further readings count, about, and counts that a task holds at once, of four bytes.
CONTEXTS_AT_ONCE, COUNTS_AT_ONCE = 1 << 18, 1 << 25
#: A chunk tells the contexts that have this share of what the chunk would have of a frequent one. The less, the fewer
#: contexts are counted that turn out not to be frequent, and the more are told.
TOLD_SHARE = 1 / 2
#: Symbols after which a task hands on its counts, so that four bytes hold each.
MOST_SEEN = 1 << 31
#: Where no more than this share of all symbols stands after contexts that may be refined, only these places are read on.
FEW = 1 / 50

_BASE, _NEXT = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
#: Powers of the inverse of _BASE and of _BASE, as many as were needed so far.
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_SHOWN = np.frombuffer(bytes(range(256)).lower().translate(bytes(32 if 9 <= k <= 13 else k for k in range(256))), np.uint8)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


# --- counts over the training documents -----------------------------------------------------------------------------


def counts(training: DataFrame) -> DataFrame:
    """key (a word, or END_WORD) and n over all training texts; written to the shared folder."""

    ship(training.sparkSession)

    def taken(held):
        data, hashes, n, start, size = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(hashes)
        first = _firsts(hashes[order])
        columns = [_cut(data, start[order[first]], size[order[first]]), pa.array(np.add.reduceat(n[order], first) if len(first) else n)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n"])

    def run(batches):
        held, seen = [], 0
        for batch in batches:
            for data, _ in text_symbols(batch):
                start, size = _tokens(data)
                hashes = _token_hashes(data, start, size)
                order = np.argsort(hashes)
                first = _firsts(hashes[order])
                one = order[first]
                held.append((data, hashes[one], np.diff(np.append(first, len(order))), start[one] + seen, size[one]))
                seen += len(data)
                if seen > HELD_SYMBOLS:
                    yield taken(held)
                    held, seen = [], 0
        if held:
            yield taken(held)

    return checkpointed(training.select("text").mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")))


def commonest(by_word: DataFrame, most: int) -> dict[bytes, int]:
    """The words whose counts reach a threshold at which they are `most` at most: found by a histogram of a few hundred
    buckets of counts, so no ranking is gathered."""
    level = F.floor(F.log2("n") * 8)
    buckets = by_word.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for b in buckets:
        total += b["words"]
        if total > most:
            break
        least = b["least"]
    return {} if least is None else {bytes(r["key"]): r["n"] for r in by_word.where(F.col("n") >= least).collect()}


# --- symbols and contexts ---------------------------------------------------------------------------------------------


def shown(own: list[bytes]) -> bytes:
    """A text's symbols: a blank, its words each ended by a blank, the end mark, and what stands outside of texts."""
    return b" ".join([b"", *own, END_BYTE + OUTSIDE])


def shown_word(word: bytes) -> bytes:
    """The same of a word, or END_WORD, alone."""
    return b" " + (END_BYTE if word == END_WORD else word + b" ") + OUTSIDE


def text_symbols(batch: pa.RecordBatch):
    """Symbols of the batch's texts, one after the other, and which of them count (None: all)."""
    fixed = [pa.scalar(x, pa.large_binary()) for x in (b" ", b" " + END_BYTE + OUTSIDE, b"")]
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        text = batch.column(0).slice(at, ROWS_AT_ONCE).cast(pa.binary()).cast(pa.large_binary()).fill_null(fixed[2])
        joined = pc.binary_join_element_wise(fixed[0], text, fixed[1], fixed[2])
        bounds = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = _SHOWN[np.frombuffer(joined.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]]
        first = np.ones(len(data), bool)
        first[1:] = (data[1:] != 32) | (data[:-1] != 32)
        yield data[first], None


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens of whole texts' symbols begin, and their sizes: after each blank a word, or END_WORD, which is that blank."""
    blank = np.flatnonzero(data == 32)
    start = blank + (data[blank + 1] != END_BYTE[0])
    size = np.append(blank[1:], len(data)) - start
    size[start == blank] = 1
    return start, size


def _token_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each token, the same wherever it stands; from running sums."""
    n = len(data)
    if _POWERS[0].size < n:
        _POWERS[:] = _times(2 * n, pow(_BASE, -1, 2**64)), _times(2 * n, _BASE)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[0][:n], out=sums[1:])
    return (sums[start + size] - sums[start]) * _POWERS[1][start]


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The stretches of the symbols as bytes."""
    ends = np.cumsum(size)
    bytes_ = data[np.arange(size.sum()) + np.repeat(start - (ends - size), size)]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(bytes_)]).cast(pa.binary())


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))


def word_symbols(batch: pa.RecordBatch):
    """The same of words that stand alone."""
    yield np.frombuffer(b"".join(map(shown_word, batch.column(0).to_pylist())), np.uint8), None


def _times(count: int, base: int) -> np.ndarray:
    """The powers of base from 0 on."""
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Contexts:
    """Hashes of contexts of one length, or other keys, and where they stand among many values."""

    def __init__(self, context: np.ndarray, length: int = 0):
        self.length, self.places = length, _Places(context)
        size = max(16, (32 * len(context)).bit_length())
        self.shift, self.maybe = np.uint64(64 - size), np.zeros(1 << size, bool)
        self.maybe[self._slot(context)] = True

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return ((values * _NEXT) >> self.shift).view(np.int64)

    def lookup(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the values are contexts, and which ones."""
        at = np.flatnonzero(self.maybe[self._slot(values)])
        place = self.places(values[at])
        there = place >= 0
        return at[there], place[there]

    def found(self, strings, before: int):
        """For each piece of symbols, with `before` ones before it where there are any: it, where it begins in its string, and the
        places of symbols after one of the contexts, that count, and which context. A context's hash comes from running sums."""
        up, down = _times(BLOCK + before, _BASE), _times(BLOCK + before, pow(_BASE, -1, 2**64))
        for data, counted in strings:
            for begin in range(0, len(data), BLOCK):
                origin = max(0, begin - before)
                piece = data[origin : begin + BLOCK]
                m, start = len(piece), max(self.length, begin - origin)
                if m <= start:
                    continue
                sums = np.zeros(m + 1, np.uint64)
                np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * down[:m], out=sums[1:])
                at, place = self.lookup((sums[start:m] - sums[start - self.length : m - self.length]) * up[start:m])
                at += start
                there = piece[at] != OUTSIDE[0]
                if counted is not None:
                    there &= counted[origin + at]
                yield piece, origin, at[there], place[there]


class _Steps:
    """An automaton that tells the longest known context before each symbol, by one step of a table a symbol.

    levels: for each length from 1 on (hash, suffix's hash, first byte) of the contexts; all suffixes are there. Its states are
    these and what is left of them without their last bytes, by length, then by hash. As no context is longer than `depth`,
    so many symbols tell the state: stretches of the symbols are followed side by side.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], column: np.ndarray, columns: int, most: int):
        self.column, self.columns = column, columns
        bytes_, hashes = [np.zeros((1, 0), np.uint8)], [np.zeros(1, np.uint64)]  # bytes from the last one back
        for context, suffix, first in levels:
            order, by = np.argsort(context), np.argsort(hashes[-1])
            before = by[np.searchsorted(hashes[-1], suffix[order], sorter=by)]
            bytes_.append(np.hstack([bytes_[-1][before], first[order, None].astype(np.uint8)]))
            hashes.append(context[order])
        self.depth = max(k for k in range(len(bytes_)) if len(bytes_[k]))
        while True:
            own, known = bytes_[: self.depth + 1], hashes[: self.depth + 1]
            for k in range(self.depth, 1, -1):
                less = np.vstack([own[k - 1], own[k][:, 1:]])
                known[k - 1], at = np.unique(self._hashes(less), return_index=True)
                own[k - 1] = less[at]
            sizes = [len(x) for x in own]
            if self.depth == 0 or sum(sizes) * columns <= most:
                break
            self.depth -= 1
        self.level_from = np.append(0, np.cumsum(sizes))
        self.size = int(self.level_from[-1])
        place = [lambda h, k=k: self.level_from[k] + np.searchsorted(known[k], h) for k in range(self.depth + 1)]
        self.suffix = np.zeros(self.size, np.int32)
        table = np.zeros((self.size, columns), np.int32)
        for k in range(self.depth + 1):
            rows = slice(self.level_from[k], self.level_from[k + 1])
            if k:
                self.suffix[rows] = place[k - 1](self._hashes(own[k][:, :-1]))
                table[rows] = table[self.suffix[rows]]
            if k < self.depth:
                table[place[k](self._hashes(own[k + 1][:, 1:])), column[own[k + 1][:, 0]]] = np.arange(self.level_from[k + 1], self.level_from[k + 2])
        self.table = (table * columns).reshape(-1)
        #: for each level's contexts, as they were given, their states
        self.states = [place[k](context) for k, (context, _, _) in enumerate(levels[: self.depth], 1)]

    @staticmethod
    def _hashes(bytes_: np.ndarray) -> np.ndarray:
        return ((bytes_.astype(np.uint64) + np.uint64(1)) * _times(bytes_.shape[1] + 1, _BASE)[1:]).sum(axis=1, dtype=np.uint64)

    def __call__(self, data: np.ndarray, start: int = 0) -> np.ndarray:
        """For each symbol from start on: the state before it, times columns, and its column. Those before start are contexts only."""
        n, before = len(data) - start, self.depth
        count = -(-n // STRETCH)
        padded = np.full(before + count * STRETCH, OUTSIDE[0], np.uint8)
        there = min(start, before)
        padded[before - there : before + n] = data[start - there :]
        side = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, before + STRETCH)[::STRETCH].T)
        columns, out, state = self.column.astype(np.int64), np.empty((STRETCH, count), np.int32), np.zeros(count, np.int32)
        for k, now in enumerate(side):
            at = columns[now]
            at += state
            if k >= before:
                out[k - before] = at
            np.take(self.table, at, out=state, mode="clip")
        return out.T.reshape(-1)[:n]

    def gathered(self, n: np.ndarray) -> np.ndarray:
        """What was counted at each longest context, summed up for all contexts."""
        n = n.reshape(self.size, self.columns)
        for k in range(self.depth, 0, -1):
            rows = slice(self.level_from[k], self.level_from[k + 1])
            np.add.at(n, self.suffix[rows], n[rows])
        return n


def _room(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many symbols of its own text stand before each place."""
    outside = np.concatenate([[-1], np.flatnonzero(data >= OUTSIDE[0])])
    return at - 1 - outside[np.searchsorted(outside, at) - 1]


def places_after(strings: DataFrame, symbols: Callable, length: int, contexts: np.ndarray, reach: int) -> DataFrame:
    """The stretches of the strings that end in a symbol after one of the contexts and begin `reach` symbols before one, those
    that meet as one: part, and skip (so many of its first symbols are there as contexts only); written to the shared folder."""
    sent = strings.sparkSession.sparkContext.broadcast(_Contexts(contexts, length))
    ship(strings.sparkSession)

    def run(batches):
        for batch in batches:
            for data, _, at, _ in sent.value.found(symbols(batch), reach):
                if not len(at):
                    continue
                start = at - np.minimum(_room(data, at), reach)
                new = np.concatenate([[True], start[1:] > at[:-1]])
                first, last = start[new], np.concatenate([at[:-1][new[1:]], at[-1:]])
                parts = [data[a : b + 1].tobytes() for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array((at[new] - first).astype(np.int32))], names=["part", "skip"])

    parts = checkpointed(strings.mapInArrow(run, "part binary, skip int"))
    return full_tasks(parts, parts.agg(F.coalesce(F.sum(F.octet_length("part")), F.lit(0))).first()[0])


def full_tasks(strings: DataFrame, n_symbols: int) -> DataFrame:
    """The strings in no more partitions than have CHUNK symbols each. In many small ones a frequent context's share comes down
    to one or two, so that all contexts would be told of each."""
    return strings.coalesce(max(1, n_symbols // CHUNK))


def part_symbols(batch: pa.RecordBatch):
    """Symbols of stretches (part, skip), and which of them count."""
    for at in range(0, batch.num_rows, 16 * ROWS_AT_ONCE):
        parts, skip = batch.slice(at, 16 * ROWS_AT_ONCE).columns
        parts = [p + OUTSIDE for p in parts.to_pylist()]
        size = np.array([len(p) for p in parts])
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        yield np.frombuffer(b"".join(parts), np.uint8), inside >= np.repeat(skip.to_numpy(), size)


# --- counts of several lengths at once ----------------------------------------------------------------------------------
#
# Places in the strings are sorted by the bytes before them, the last byte first, so that all contexts that are each other's
# suffixes lie together. The bytes are taken in levels of a few: a level's key is the node reached so far (a context of the
# level's first length), the level's bytes and, where they are counted, the byte that follows.


class _Chunk:
    """Symbols of many strings, and the places in them that are counted."""

    def __init__(self, pieces: list[tuple], longest: int, starts: _Contexts | None):
        pad = np.full(longest + 8, OUTSIDE[0], np.uint8)
        self.data, self.pad = np.concatenate([pad, *(d for d, _ in pieces)]), len(pad)
        self.by8 = np.ndarray((len(self.data) - 7,), "<u8", self.data, 0, (1,))
        self.by4 = np.ndarray((len(self.data) - 3,), "<u4", self.data, 0, (1,))
        self.starts = starts
        if starts is None:
            self.size = len(self.data) - self.pad - 2 * int((self.data[self.pad :] == OUTSIDE[0]).sum())
            return
        counted = None
        if pieces[0][1] is not None:
            counted = np.concatenate([np.zeros(len(pad), bool), *(c for _, c in pieces)])
        at = [(origin + at, place) for _, origin, at, place in starts.found([(self.data, counted)], starts.length)]
        self.at, self.node = np.concatenate([a for a, _ in at]), np.concatenate([p for _, p in at])
        self.size = len(self.at)

    def first(self, most: int):
        """Keys of the first level with the following byte, and their places; all places of the chunk by pieces."""
        if self.starts is None:
            for a in range(self.pad, len(self.data), most):
                b = min(len(self.data), a + most)
                v = self.by8[a - 7 : b - 7].astype(np.uint64)
                x = v << np.uint64(8)
                v >>= np.uint64(56)
                x |= v
                del v
                yield x, range(a, b)
        else:
            for a in range(0, self.size, most):
                at = self.at[a : a + most]
                yield self.next(at, self.node[a : a + most], self.starts.length), at

    def next(self, at: np.ndarray, node: np.ndarray, length: int) -> np.ndarray:
        """Keys of a further level: node, four bytes, following byte."""
        return (node.astype(np.uint64) << np.uint64(32) | self.by4[at - (length + 4)]) << np.uint64(8) | self.data[at]


def _runs(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and how often each occurs."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    if n is None:
        return keys[start], np.diff(np.append(start, len(keys))).astype(np.int32)
    return keys[start], np.add.reduceat(n, start) if len(start) else n


def _extended(start: np.ndarray, prefix: np.ndarray, length: int, j: int) -> np.ndarray:
    """Hashes of contexts: of `length` bytes with the hash `start`, and j bytes before these."""
    out = start.copy()
    for k in range(1, j + 1):
        byte = prefix >> np.uint64(8 * (j - k)) & np.uint64(255)
        out += (byte + np.uint64(1)) * np.uint64(pow(_BASE, length + k, 2**64))
    return out


def _chunks(batches, symbols: Callable, longest: int, starts: _Contexts | None):
    """A task's symbols in chunks of CHUNK and more; only a task that has fewer makes a smaller one."""
    held, size, ready = [], 0, []
    for batch in batches:
        for piece in symbols(batch):
            held.append(piece)
            size += len(piece[0])
            if size >= CHUNK:
                if ready:
                    yield _Chunk(ready, longest, starts)
                ready, held, size = held, [], 0
    if ready or held:
        yield _Chunk(ready + held, longest, starts)


def _mined(chunk: _Chunk, length: int, widths: list[int], hashes: np.ndarray, least: float):
    """(length, hash of the level's first context, further bytes, n) of the contexts that occur `least` times in the chunk."""
    keys, at, pieces = None, None, []
    for k, width in enumerate(widths):
        if k == 0:
            found = [_runs(x >> np.uint64(8)) for x, _ in chunk.first(SORTED_AT_ONCE)]
            unique, n = found[0] if len(found) == 1 else _runs(*(np.concatenate(x) for x in zip(*found))) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        else:
            unique, n = _runs(keys)
        for j in range(width, 0, -1):
            prefix = unique >> np.uint64(8 * (width - j))
            start = np.flatnonzero(np.concatenate([np.ones(min(1, len(prefix)), bool), prefix[1:] != prefix[:-1]]))
            times = np.add.reduceat(n, start) if len(start) else n
            often = times >= least
            prefix, times = prefix[start[often]], times[often]
            inside = np.ones(len(prefix), bool)
            for i in range(j):
                inside &= (prefix >> np.uint64(8 * i) & np.uint64(255)) < OUTSIDE[0]
            prefix = prefix[inside]
            node = (prefix >> np.uint64(8 * j)).astype(np.int64)
            own = prefix & np.uint64((1 << 8 * j) - 1)
            yield length + j, hashes[node], own, times[inside]
            if j == width:
                full, full_hashes = prefix, _extended(hashes[node], own, length, j)
        if not len(full) or k + 1 == len(widths):
            return
        wanted, pieces = _Contexts(full), []
        for x, places in chunk.first(SOUGHT_AT_ONCE) if k == 0 else ((keys[a : a + SOUGHT_AT_ONCE], at[a : a + SOUGHT_AT_ONCE]) for a in range(0, len(at), SOUGHT_AT_ONCE)):
            there, node = wanted.lookup(x >> np.uint64(8) if k == 0 else x)
            own = there + places.start if isinstance(places, range) else places[there]
            pieces.append((own, chunk.next(own, node, length + width) >> np.uint64(8)))
        at, keys = (np.concatenate(x) for x in zip(*pieces))
        length, hashes, pieces = length + width, full_hashes, []


def mine(strings: DataFrame, symbols: Callable, length: int, widths: list[int], frontier: np.ndarray, n_all: int, least: int) -> tuple[np.ndarray, ...]:
    """(length, start, prefix, n): at least the contexts that occur `least` times and are longer than `length`, with a suffix in the
    frontier (all, if length is 0), by levels: the hash of a level's first context, and the bytes before it. Of length 0: the
    pairs of symbols and their n, of length -1: the number of chunks.

    A chunk tells a context that occurs `told` times in it, and by how much more than told - 1. The chunks' told - 1 are
    TOLD_SHARE of `least` in all, at most, so a context that has less than the rest of `least` above them cannot occur so
    often. Three quarters are shared by the chunks' parts of the n_all places, the rest equally, so that in small chunks not
    everything is often enough. A context's suffixes are told where it is, so none that is here lacks them.
    """
    n_chunks = max(1, strings.rdd.getNumPartitions() + n_all // CHUNK)
    rows = _mine(strings, symbols, length, widths, frontier, n_all, least, n_chunks)
    chunks = int(rows[3][rows[0] < 0].sum())
    if chunks > n_chunks:  # Spark ran more tasks than it had planned
        rows = _mine(strings, symbols, length, widths, frontier, n_all, least, 2 * chunks)
        if rows[3][rows[0] < 0].sum() > 2 * chunks:
            raise RuntimeError("the strings come in ever more partitions")
    return rows


def _mine(strings: DataFrame, symbols: Callable, length: int, widths: list[int], frontier: np.ndarray, n_all: int, least: int, n_chunks: int) -> tuple[np.ndarray, ...]:
    ship(strings.sparkSession)
    sent = strings.sparkSession.sparkContext.broadcast(_Contexts(frontier, length) if length else None)

    def run(batches):
        names = ["length", "start", "prefix", "n"]
        pairs, chunks = np.zeros(1 << 16, np.int64), 0
        for chunk in _chunks(batches, symbols, length + sum(widths), sent.value):
            chunks += 1
            if not length:
                for a in range(chunk.pad, len(chunk.data), SORTED_AT_ONCE):
                    b = min(len(chunk.data), a + SORTED_AT_ONCE)
                    pairs += np.bincount(chunk.data[a - 1 : b - 1].astype(np.uint16) << np.uint16(8) | chunk.data[a:b], minlength=1 << 16)
            if chunk.size:
                told = max(1, int(TOLD_SHARE * least * (0.75 * chunk.size / n_all + 0.25 / n_chunks)))
                for size, start, prefix, times in _mined(chunk, length, widths, frontier, told):
                    columns = np.full(len(start), size, np.int32), start.view(np.int64), prefix.view(np.int64), times.astype(np.int64) - (told - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)
        at = np.flatnonzero(pairs)
        columns = np.append(np.zeros(len(at), np.int32), np.int32(-1)), np.zeros(len(at) + 1, np.int64), np.append(at, 0), np.append(pairs[at], chunks)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    mined = strings.mapInArrow(run, "length int, start long, prefix long, n long")
    summed = mined.groupBy("length", "start", "prefix").agg(F.sum("n").alias("n"))
    rows = summed.where((F.col("length") < 1) | (F.col("n") >= math.floor((1 - TOLD_SHARE) * least))).toArrow()
    sent.unpersist()
    return tuple(rows[c].to_numpy().view(kind) for c, kind in (("length", np.int32), ("start", np.uint64), ("prefix", np.uint64), ("n", np.int64)))


class _Trie:
    """Contexts to be counted, by levels; row numbers run over all of them, a length's are next to each other."""

    def __init__(self, length: int, widths: list[int], frontier: np.ndarray, lengths: np.ndarray, start: np.ndarray, prefix: np.ndarray):
        self.length, self.widths, self.keys, self.at, self.nodes = length, widths, [], [], []
        self.row_from, self.context, self.suffix, self.first = [], [], [], []
        hashes, rows = frontier, 0
        for width in widths:
            order = np.argsort(hashes)
            for j in range(1, width + 1):
                own = lengths == length + j
                node = order[np.searchsorted(hashes[order], start[own])]
                key = node.astype(np.uint64) << np.uint64(8 * j) | prefix[own]
                by = np.argsort(key)
                key, begin, bytes_ = key[by], start[own][by], prefix[own][by]
                self.keys.append(key)
                self.row_from.append(rows)
                self.context.append(_extended(begin, bytes_, length, j))
                self.suffix.append(_extended(begin, bytes_ >> np.uint64(8), length, j - 1))
                self.first.append((bytes_ & np.uint64(255)).astype(np.int64))
                rows += len(key)
            self.nodes.append(_Contexts(key))
            length, hashes = length + width, self.context[-1]
        self.row_from.append(rows)
        self.size = rows


def _count_level(keys: np.ndarray, trie: _Trie, level: int, code: np.ndarray, n: np.ndarray, from_row: int) -> None:
    """Add to n, whose rows begin at from_row, how often each symbol follows the contexts of a level."""
    first, width = sum(trie.widths[:level]), trie.widths[level]
    unique, times = _runs(keys)
    follows = code[(unique & np.uint64(255)).astype(np.uint8)]
    inside = follows >= 0
    unique, times, follows = unique[inside] >> np.uint64(8), times[inside], follows[inside]
    flat, n_codes = n.reshape(-1), n.shape[1]
    for j in range(width, 0, -1):
        row = trie.row_from[first + j - 1]
        wanted = trie.keys[first + j - 1][max(0, from_row - row) : max(0, from_row + len(n) - row)]
        row = max(0, row - from_row)
        if not len(wanted) or not len(unique):
            continue
        prefix = unique >> np.uint64(8 * (width - j))
        start = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        runs = prefix[start]
        place = np.minimum(np.searchsorted(wanted, runs), len(wanted) - 1)
        known, size = wanted[place] == runs, np.diff(np.append(start, len(prefix)))
        there = np.repeat(known, size)
        np.add.at(flat, np.repeat((place[known] + row) * n_codes, size[known]) + follows[there], times[there])


def _steps_of(trie: _Trie, following: np.ndarray) -> tuple[_Steps, np.ndarray, np.ndarray] | None:
    """An automaton of the trie's contexts, the states of its rows and the columns of the symbols; None if it would be too large."""
    bytes_ = np.unique(np.concatenate([following, *trie.first]))
    column = np.full(256, len(bytes_), np.int32)
    column[bytes_] = np.arange(len(bytes_))
    steps = _Steps(list(zip(trie.context, trie.suffix, trie.first)), column, len(bytes_) + 1, MOST_STEPS)
    if any(len(x) for x in trie.context[steps.depth :]):
        return None
    return steps, np.concatenate(steps.states), column[following]


def count(strings: DataFrame, symbols: Callable, trie: _Trie, frontier: np.ndarray, following: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(row of the trie, symbol, n), sorted: of the contexts that occur `least` times, how often each symbol follows. Counted over
    all strings; tasks hand on their counts by blocks of rows, which are summed up apart. More rows than a task should hold
    are counted in several readings."""
    ship(strings.sparkSession)
    n_codes = len(following)
    code = np.full(256, -1, np.int64)
    code[following] = np.arange(n_codes)
    block = max(1, (1 << 16) // n_codes) * n_codes
    length, widths = trie.length, trie.widths
    steps = _steps_of(trie, following) if not length else None
    sent = strings.sparkSession.sparkContext.broadcast(steps or (trie, _Contexts(frontier, length) if length else None))

    def taken(n):
        n = n.reshape(-1)
        for k in range(0, len(n), block):
            at = np.flatnonzero(n[k : k + block])
            if len(at):  # bytes of the same worth together, so that the many zeros pack well
                packed = np.diff(at, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), n[k + at].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k // block], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=["block", "at", "n"])

    def run(batches, from_row=0, to_row=0):
        trie, starts = sent.value
        n, seen = np.zeros((to_row - from_row, n_codes), np.int32), 0
        for chunk in _chunks(batches, symbols, length + sum(widths), starts):
            if seen + len(chunk.data) >= MOST_SEEN:
                yield from taken(n)
                n[:], seen = 0, 0
            seen += len(chunk.data)
            pieces, size = [], length + widths[0]
            for keys, places in chunk.first(COUNTED_AT_ONCE):
                _count_level(keys, trie, 0, code, n, from_row)
                there, node = trie.nodes[0].lookup(keys >> np.uint64(8))
                pieces.append((there + places.start if isinstance(places, range) else places[there], node))
            for level in range(1, len(widths)):
                keys, further = None, []
                if not pieces:
                    break
                at, node = (np.concatenate(x) for x in zip(*pieces))
                for a in range(0, len(at), COUNTED_AT_ONCE):
                    keys = chunk.next(at[a : a + COUNTED_AT_ONCE], node[a : a + COUNTED_AT_ONCE], size)
                    _count_level(keys, trie, level, code, n, from_row)
                    there, own = trie.nodes[level].lookup(keys >> np.uint64(8))
                    further.append((at[a + there], own))
                pieces, size = further, size + widths[level]
        yield from taken(n)

    def run_by_steps(batches):
        steps, rows, codes = sent.value
        n, seen = np.zeros(steps.size * steps.columns, np.int32), 0

        def told():
            return taken(np.ascontiguousarray(steps.gathered(n)[rows][:, codes]))

        for chunk in _chunks(batches, symbols, 0, None):
            if seen + len(chunk.data) >= MOST_SEEN:
                yield from told()
                n[:], seen = 0, 0
            seen += len(chunk.data)
            at = [steps(chunk.data[max(0, k - steps.depth) : k + SCORED_AT_ONCE], min(k, steps.depth)) for k in range(0, len(chunk.data), SCORED_AT_ONCE)]
            np.add(n, np.bincount(np.concatenate(at), minlength=len(n)), out=n, casting="unsafe")
        yield from told()

    def total(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = held.setdefault(k, np.zeros(block, np.int64))
                at = np.cumsum(np.frombuffer(at, np.uint8).reshape(2, -1).T.copy().view("<u2")[:, 0].astype(np.int64))
                own[at] += np.frombuffer(n, np.uint8).reshape(8, -1).T.copy().view("<i8")[:, 0]
        for k, own in held.items():
            own = own.reshape(-1, n_codes)
            own[own.sum(axis=1) < least] = 0
            row, symbol = np.nonzero(own)
            columns = row + k * (block // n_codes), following[symbol], own[row, symbol]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["row", "next", "n"])

    out, most = [], trie.size if steps else max(1, COUNTS_AT_ONCE // n_codes)
    for k in range(0, trie.size, most):
        packed = strings.mapInArrow(run_by_steps if steps else partial(run, from_row=k, to_row=min(trie.size, k + most)), "block int, at binary, n binary")
        rows = packed.repartition("block").mapInArrow(total, "row long, next long, n long").toArrow()
        row, symbol, n = (rows[c].to_numpy() for c in ("row", "next", "n"))
        order = np.lexsort((symbol, row))
        out.append((row[order] + k, symbol[order], n[order]))
    sent.unpersist()
    return tuple(np.concatenate(x) for x in zip(*out))


def longer(strings: DataFrame, symbols: Callable, length: int, widths: list[int], frontier: np.ndarray, n_all: int, least: int, following: np.ndarray | None = None):
    """For each length (context, suffix, first byte, next, n), sorted by context, of the contexts that occur `least` times: those
    longer than `length` with a suffix in the frontier. With length 0 the first of the lengths is 0, the pairs of symbols."""
    lengths, start, prefix, n = mine(strings, symbols, length, widths, frontier, n_all, least)
    if not length:
        pairs = np.zeros(1 << 16, np.int64)
        pairs[prefix[lengths == 0].astype(np.int64)] = n[lengths == 0]
        pairs = pairs.reshape(256, 256)
        pairs[[END_BYTE[0], OUTSIDE[0]]] = 0  # nothing follows the end
        pairs[:, OUTSIDE[0]] = 0
        following = np.flatnonzero(pairs.sum(axis=0))
        none = np.zeros(len(following), np.uint64)
        yield none, none, none, following, pairs.sum(axis=0)[following]
    trie = _Trie(length, widths, frontier, lengths, start, prefix)
    row, symbol, n = count(strings, symbols, trie, frontier, following, least) if trie.size else (np.zeros(0, np.int64),) * 3
    bounds = np.searchsorted(row, trie.row_from)
    for k in range(sum(widths)):
        own = slice(bounds[k], bounds[k + 1])
        at = row[own] - trie.row_from[k]
        context = trie.context[k][at]
        order = np.lexsort((symbol[own], context))
        at = at[order]
        yield context[order], trie.suffix[k][at], trie.first[k][at], symbol[own][order], n[own][order]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


# --- the tree ---------------------------------------------------------------------------------------------------------


class _Places:
    """Places of keys by open addressing with three slots in four free, for look-ups of whole arrays."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, (4 * len(keys)).bit_length() - 1)
        self.mask, self.keys, self.place = np.uint64(size - 1), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left, at, self.most = np.arange(len(keys)), self._home(keys), 0
        while len(left):  # of several keys for a free slot one gets it, the others go on
            free = self.place[at] < 0
            self.place[at[free]] = left[free]
            self.keys[at[free]] = keys[left[free]]
            lost = self.place[at] != left
            left, at = left[lost], (at[lost] + np.uint64(1)) & self.mask
            self.most += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * _NEXT
        mixed ^= mixed >> np.uint64(32)
        mixed &= self.mask
        return mixed

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        at = self._home(keys)
        out = self.place[at]
        left = np.flatnonzero((self.keys[at] != keys) & (out >= 0))  # the slot is another's: look at the next one
        at = at[left]
        while len(left):
            at = (at + np.uint64(1)) & self.mask
            place = self.place[at]
            out[left] = place
            going = np.flatnonzero((self.keys[at] != keys[left]) & (place >= 0))
            left, at = left[going], at[going]
        return out


class _Grown:
    """An array that is added to."""

    def __init__(self, *first):
        self.held, self.n = np.array(first), len(first)

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            self.held = np.concatenate([self.all, np.zeros(self.n + 2 * len(more), self.held.dtype)])
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.n]


class Tree:
    """Contexts from the predicted symbol backwards, and what may follow each.

    From the empty context on, a context's distribution is its counts, smoothed by its suffix's with the weight of as many
    observations as it has different followers. Where they do not diverge enough the context is not kept: its node, there
    for longer ones, points to its longest kept suffix.
    """

    def __init__(self):
        self.root = np.full(256, 1 / 256)
        self.kept = [1]
        self.points_to, self.log_rest, self.up, self.child_keys = _Grown(0), _Grown(0.0), _Grown(0), _Grown(np.uint64(0))
        self.pair_keys, self.pair_p = _Grown(np.uint64(0)), _Grown(1.0)  # by node and symbol; node 0 has its own array
        self.n_nodes, self.level_at, self.levels = 1, {0: (np.zeros(1, np.uint64), np.zeros(1, np.int64))}, []

    def add(self, length: int, context: np.ndarray, suffix: np.ndarray, first: np.ndarray, following: np.ndarray, n: np.ndarray) -> np.ndarray:
        """One more length, rows by context (a hash), with its suffix and first byte; returns the frontier, the sorted
        contexts that longer ones may refine."""
        if length == 0:
            total = n.sum()
            prior = max(len(n), 1)
            p = np.bincount(following, n, 256)
            self.root = (p + prior * self.root) / (total + prior)
            return np.zeros(1, np.uint64)
        nodes, at = np.unique(context, return_index=True)
        if not len(nodes):
            return nodes
        each = np.diff(np.append(at, len(context)))
        total, distinct = np.add.reduceat(n, at), each
        known, ids = self.level_at[length - 1]
        parent = ids[np.searchsorted(known, suffix[at])]
        up = self.points_to.all[parent]
        row = np.repeat(np.arange(len(nodes)), each)
        base = self.probability(up[row], following)
        share = n / total[row]
        far = np.add.reduceat(n * np.log(share / base), at)
        keep = far >= MIN_DIVERGENCE
        own = self.n_nodes + np.arange(len(nodes))
        self.child_keys.add((parent * 256 + first[at]).astype(np.uint64))
        self.points_to.add(np.where(keep, own, up))
        self.log_rest.add(np.where(keep, np.log10(distinct / (total + distinct)), 0.0))
        self.up.add(up)
        kept = keep[row]
        self.pair_keys.add((own[row] * 256 + following).astype(np.uint64)[kept])
        self.pair_p.add(((n + distinct[row] * base) / (total + distinct)[row])[kept])
        self.level_at[length], self.n_nodes = (nodes, own), self.n_nodes + len(nodes)
        if length <= NEAR_LENGTHS:
            self.levels.append((nodes, suffix[at], first[at]))
        self.kept.append(int(keep.sum()))
        spread = -np.add.reduceat(n * np.log(share), at)
        return nodes[spread >= MIN_DIVERGENCE]

    def probability(self, node: np.ndarray, following: np.ndarray) -> np.ndarray:
        """p(following | node) for kept nodes, by sorted search; used while the tree grows."""
        keys, p, rest, up = self.pair_keys.all, self.pair_p.all, self.log_rest.all, self.up.all
        out, node, left = np.zeros(len(node)), node.copy(), np.arange(len(node))
        while len(left):
            at_root = node[left] == 0
            out[left[at_root]] += np.log10(self.root[following[left[at_root]]])
            left = left[~at_root]
            wanted = (node[left] * 256 + following[left]).astype(np.uint64)
            hit = _among(wanted, keys)
            out[left[hit]] += np.log10(p[np.searchsorted(keys, wanted[hit])])
            left = left[~hit]
            out[left] += rest[node[left]]
            node[left] = up[node[left]]
        return 10.0**out

    def finish(self) -> Tree:
        """Put the tree into the form in which it is sent and asked; nodes that lead to no kept one go."""
        points, up, rest, keys = self.points_to.all, self.up.all, self.log_rest.all, self.child_keys.all
        used = points == np.arange(len(points))
        for length in range(max(self.level_at), 0, -1):  # a look-up walks from length to length
            own = self.level_at[length][1]
            used[(keys[own[used[own]]] >> np.uint64(8)).astype(np.int64)] = True
        self.depth = max([k for k, (_, own) in self.level_at.items() if used[own].any()], default=0)
        # tables over the bytes that occur in the tree, and one column for all others
        own = np.flatnonzero(used)[1:]
        pairs, p = self.pair_keys.all[1:], self.pair_p.all[1:]
        bytes_ = np.unique(np.concatenate([keys[own], pairs]) & np.uint64(255)).astype(np.int64)
        self.columns = len(bytes_) + 1
        self.column = np.full(256, len(bytes_), np.int32)
        self.column[bytes_] = np.arange(len(bytes_))
        parent = (keys[own] >> np.uint64(8)).astype(np.int64)
        parents = np.unique(parent)
        self.parent = np.zeros(len(points), np.int32)  # row 0: no children
        self.parent[parents] = 1 + np.arange(len(parents))
        self.child = np.full((1 + len(parents)) * self.columns, -1, np.int32)
        self.child[self.parent[parent] * np.int64(self.columns) + self.column[(keys[own] & np.uint64(255)).astype(np.int64)]] = own
        kept = points == np.arange(len(points))
        row = np.cumsum(kept) - 1
        node, byte = (pairs >> np.uint64(8)).astype(np.int64), self.column[(pairs & np.uint64(255)).astype(np.int64)]
        log_p = np.zeros((row[-1] + 1, self.columns), np.float32)
        log_p[0, :-1] = np.log10(self.root[bytes_])
        order = np.argsort(node, kind="stable")
        node, byte, log = node[order], byte[order], np.log10(p[order])
        for length in range(1, max(self.level_at) + 1):  # what does not follow a context has its suffix's share of the rest
            own = self.level_at[length][1]
            log_p[row[own[kept[own]]]] = log_p[row[up[own[kept[own]]]]] + rest[own[kept[own]], None]
            a, b = np.searchsorted(node, [own[0], own[-1] + 1])
            log_p[row[node[a:b]], byte[a:b]] = log[a:b]
        self.log_p, self.points, self.root_log = log_p.reshape(-1), row[points].astype(np.int32), np.log10(self.root)
        near, nodes = [], [np.zeros(1, np.int64)]
        for length, level in enumerate(self.levels[: self.depth], 1):
            there = used[self.level_at[length][1]]
            near.append(tuple(x[there] for x in level))
            nodes.append(self.level_at[length][1][there])
        for name in ("points_to", "log_rest", "up", "child_keys", "pair_keys", "pair_p", "level_at", "levels"):
            self.__dict__.pop(name, None)
        size = sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))
        self.steps = _Steps(near, self.column, self.columns, min(MOST_STEPS, max(0, MOST_TREE_BYTES - size) // 8))
        # a state that is no node of the tree stands for its longest suffix that is one
        self.node = np.full(self.steps.size, -1, np.int32)
        for state, own in zip([np.zeros(1, np.int64), *self.steps.states], nodes):
            self.node[state] = own
        for k in range(1, self.steps.depth + 1):
            rows = np.arange(self.steps.level_from[k], self.steps.level_from[k + 1])
            rows = rows[self.node[rows] < 0]
            self.node[rows] = self.node[self.steps.suffix[rows]]
        size += self.node.nbytes + self.steps.table.nbytes + self.steps.suffix.nbytes
        if size > MOST_TREE_BYTES:
            raise ValueError(f"the tree has {size} bytes, more than MOST_TREE_BYTES")
        self.bytes = size
        return self

    def each(self, data: np.ndarray, start: int) -> np.ndarray:
        """log10 of the probability of each symbol from start on; those before it are contexts only. Zero for a first blank
        and for what stands outside of texts."""
        step = self.steps(data, start)
        state = step // np.int32(self.columns)
        column = step - state * np.int32(self.columns)
        node, at = self.node[state], np.flatnonzero(state >= self.steps.level_from[-2]) + start
        for length in range(self.steps.depth + 1, self.depth + 1):  # the many later lengths, with few places each, of all together
            at = at[at >= length]
            if not len(at):
                break
            child = self.child[self.parent[node[at - start]] * np.int64(self.columns) + self.column[data[at - length]]]
            there = np.flatnonzero(child >= 0)
            at = at[there]
            node[at - start] = child[there]
        out = self.log_p[self.points[node] * np.int64(self.columns) + column].astype(float)
        own, last = data[start:], np.append(data[start - 1] if start else OUTSIDE[0], data[start:-1])
        other = np.flatnonzero(column == self.columns - 1)
        out[other] += self.root_log[own[other]]
        out[(own == OUTSIDE[0]) | (last == OUTSIDE[0])] = 0
        return out

    def of(self, strings: list[bytes]) -> np.ndarray:
        """log10 of the probability of each string of symbols."""
        if not strings:
            return np.zeros(0)
        return self.of_symbols(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *(len(x) for x in strings[:-1])]))

    def of_symbols(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The same of symbols one after the other, and where each string begins."""
        parts = [self.each(data[max(0, k - self.depth - 2) : k + SCORED_AT_ONCE], min(k, self.depth + 2)) for k in range(0, len(data), SCORED_AT_ONCE)]
        return np.add.reduceat(np.concatenate(parts), begin)

    def log10(self, own: list[bytes]) -> np.ndarray:
        """Of each word (or END_WORD) that stands alone: log10 of its probability, its ending blank included."""
        return self.of([shown_word(w) for w in own])


def grow(strings: DataFrame, symbols: Callable, n_symbols: int) -> Tree:
    """The tree of strings: several lengths in two readings, as long as contexts are frequent and can still be refined. Where few
    places stand after such contexts, these are written out with what is before them, and read on instead of the strings."""
    least = max(LEAST_COUNT, math.ceil(n_symbols ** (2 / 3) / CONTEXT_SHARE))
    strings = full_tasks(strings, n_symbols)
    tree, length, frontier, n_open, reach = Tree(), 0, np.zeros(1, np.uint64), n_symbols, 0
    following, places, widths = None, (strings, symbols), FIRST_WIDTHS
    while True:
        for rows in longer(*places, length, widths, frontier, n_open, least, following):
            if following is None:
                following = rows[3]
                frontier = tree.add(0, *rows)
                continue
            near = _among(rows[1], frontier)
            rows, length = tuple(x[near] for x in rows), length + 1
            frontier = tree.add(length, *rows)
            if not len(frontier):
                return tree.finish()
            n_open = int(rows[4][_among(rows[0], frontier)].sum())
        if n_open <= FEW * n_symbols and length + 4 > reach:
            reach = 8 * length
            places = places_after(strings, symbols, length, frontier, reach), part_symbols
        levels = min(length, CONTEXTS_AT_ONCE * least // n_open) // 4
        widths = [4] * max(1, min(levels, (reach - length) // 4) if places[0] is not strings else levels)


def learn(by_word: DataFrame) -> Tree:
    """The tree of counted words that stand alone."""
    each = by_word.select(F.explode(F.array_repeat("key", F.col("n").cast("int"))).alias("key"))
    return grow(each, word_symbols, symbols_of(by_word))


def symbols_of(by_word: DataFrame) -> int:
    """The number of symbols that the tree predicts in texts of these words."""
    size = F.when(F.col("key") == END_WORD, 1).otherwise(F.octet_length("key") + 1)
    return by_word.agg(F.coalesce(F.sum(F.col("n") * size), F.lit(0))).first()[0]


def score(docs: DataFrame, training: DataFrame, sent_words: int = SENT_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of docs.

    base_score sums log10((c + 1) / (N + V + 1)) over the words and the end token; score is the tree's log10 probability of
    the text: of its words' bytes, the blank after each, and the end, each given all that the text has before it. Null and empty texts are an end token alone.
    Repeated rows are scored each; an empty training table leaves N = 0 and a uniform tree. Common words' counts go to
    every task, sent_words of them at most; a text's other words meet their counts in a join, keyed by word, and come back
    summed by row, so no vocabulary has to fit into a task. Texts are scored whole.
    """
    spark = docs.sparkSession
    by_word = counts(training)
    total, distinct = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common = commonest(by_word, sent_words)
    tree = grow(training.select("text"), text_symbols, symbols_of(by_word))
    known = np.frombuffer(b"".join(common), np.uint8), np.array([len(w) for w in common], np.int64)
    hashes = _token_hashes(known[0], np.cumsum(known[1]) - known[1], known[1])
    n_known = np.array([*common.values()], float)
    sent = spark.sparkContext.broadcast((tree, _Contexts(hashes), np.log10(n_known + 1), n_known > 0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ship(spark)

    def run(batches):
        tree, listed, logs, seen = sent.value
        row, names = TaskContext.get().partitionId() << 40, ["row", "key", "doc_id", "k", "known", "base", "whole"]
        for batch in batches:
            for begin, (data, _) in zip(range(0, batch.num_rows, ROWS_AT_ONCE), text_symbols(batch.select(["text"]))):
                ids = batch.column("doc_id").slice(begin, ROWS_AT_ONCE)
                n, ends = len(ids), np.flatnonzero(data == OUTSIDE[0]) + 1
                if len(ends) != n:
                    raise ValueError("a text is not UTF-8")
                start, size = _tokens(data)
                hashes = _token_hashes(data, start, size)
                text = np.searchsorted(ends, start, "right")
                at, place = listed.lookup(hashes)
                rare = np.ones(len(start), bool)
                rare[at] = False
                rare = np.flatnonzero(rare)
                mixed = hashes[rare] + text[rare].astype(np.uint64) * _NEXT  # the same word of the same text
                order = np.argsort(mixed)
                first = _firsts(mixed[order])
                one = rare[order[first]]
                rows = np.arange(row, row + n)
                row += n
                mark = [b"  " + r.to_bytes(8, "big") for r in rows.tolist()]  # a key that no word is, so that no row is without one
                rest = pa.nulls(len(one))

                def padded(column):
                    return pa.concat_arrays([column, rest.cast(column.type)])  # noqa: B023

                columns = [
                    pa.array(np.concatenate([rows, rows[text[one]]])), pa.concat_arrays([pa.array(mark, pa.binary()), _cut(data, start[one], size[one])]), padded(ids),
                    pa.array(np.concatenate([np.bincount(text, minlength=n), np.diff(np.append(first, len(order)))])), padded(pa.array(np.bincount(text[at], seen[place], n).astype(np.int64))),
                    padded(pa.array(np.bincount(text[at], logs[place], n).astype(float))), padded(pa.array(tree.of_symbols(data, np.append(0, ends[:-1])))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    flat = docs.select("doc_id", "text").mapInArrow(run, f"row long, key binary, doc_id {kind}, k long, known long, base double, whole double")
    met = flat.join(by_word, "key", "left")
    rare = F.col("whole").isNull()
    summed = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(~rare, F.col("k"))).alias("n_tokens"),
        F.sum(F.when(~rare, F.col("known")).when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("n_known"),
        F.sum(F.when(~rare, F.col("base")).when(F.col("n") > 0, F.col("k") * F.log10(F.col("n") + 1)).otherwise(0.0)).alias("logs"),
        F.max("whole").alias("score"),
    )
    return summed.select(
        "doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"), "score",
    )


def score_held_out(docs: DataFrame) -> DataFrame:
    """Learn from documents whose id's remainder of 7 is not 2 and score all; adds held_out."""
    held = id_remainder(F.col("doc_id"), 7) == 2
    out = score(docs.select("doc_id", "text"), docs.where(~held).select("text"))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
