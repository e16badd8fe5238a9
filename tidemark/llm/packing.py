"""Order-preserving packing of tokenised documents into fixed windows by dynamic programming."""

from __future__ import annotations

import functools
import os
import re
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.common import map_texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_OF_DOCUMENT = 2
WINDOW = 4096
#: What a cut costs, in padding tokens: at a sentence's end within a document, or anywhere else within one.
SENTENCE_CUT, HARD_CUT = 4, 32
#: Without a sentence's end for so many tokens, cuts are offered at this distance.
HARD_GRID = 64
#: Tokens over which one run of the dynamic programme chooses cuts; the last window moves on to the next run.
BLOCK_TOKENS = 1 << 19
#: Chunks of text whose ids a worker remembers.
REMEMBERED = 600_000

#: Texts with such a character, or with what may be a special token, take the tokenizer's whole way.
_NOT_LATIN = re.compile("[^\x00-\u024f]|\u0130")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """Ids by lower-cased chunk. A new run of letters goes straight to the merges; with a mark behind it, it is put
    together of the two, as the mark is a piece of its own; any other chunk goes the whole way."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.merges, self.bytes = tokenizer, tokenizer.model, _byte_letters()
        self.marks = {m[0]: packed(tokenizer.encode(m.decode(), add_special_tokens=False).ids) for m in (b".", b",", b"!", b"?")}

    def __missing__(self, chunk: bytes) -> bytes:
        run = chunk.decode()
        if chunk[-1] in self.marks and run[:-1].isalpha():
            out = self[chunk] = self[chunk[:-1]] + self.marks[chunk[-1]]
            return out
        if run.isalpha():
            ids = [t.id for t in self.merges.tokenize(run if run.isascii() else "".join(map(self.bytes.__getitem__, chunk)))]
        else:
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        out = self[chunk] = packed(ids)
        return out


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The tokenizer lower-cases, drops white space and never merges across it, so a text's ids are those of its
    blank-separated chunks. Chunks recur, and their ids are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Known(self.tokenizer)
        self.end = packed([END_OF_DOCUMENT])

    def one(self, text: str) -> bytes:
        if "<|" in text or not text.isascii() and _NOT_LATIN.search(text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids) + self.end
        return b"".join(map(self.known.__getitem__, text.lower().encode().split())) + self.end

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return [self.one(t or "") for t in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """A worker's encoder; what it remembers serves its later tasks too."""
    return Encoder(path)


def sentence_ends(tokenizer: Tokenizer) -> np.ndarray:
    """For each id, whether a sentence may end with it."""
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for piece, i in tokenizer.get_vocab().items():
        ends[i] = piece.removesuffix("</w>")[-1:] in (".", "!", "?") and piece.endswith("</w>")
    return ends


def rest_cost(length: int, window: int = WINDOW) -> int:
    """Of the last window of a split: its padding, or hard cuts into powers of two, which need none."""
    return min(window - length, (length.bit_count() - 1) * HARD_CUT)


def cut_windows(positions: np.ndarray, penalties: np.ndarray, window: int = WINDOW, rest: Callable[[int], int] | None = None) -> list[int]:
    """Cuts (indices of positions, the first and last included) of least cost: padding of all windows plus the penalties
    of the cuts; rest, if given, is the cost of the last window by its length. positions rise from 0 by at most window a
    step; linear time by a monotone queue."""
    at, cost = positions.tolist(), penalties.tolist()
    best, back = [0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])  # starts that can still be best, by best + position
    for j in range(1, len(at)):
        while at[j] - at[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        best[j] = best[i] + window - (at[j] - at[i]) + cost[j]
        back[j] = i
        rank = best[j] + at[j]
        while queue and best[queue[-1]] + at[queue[-1]] >= rank:
            queue.pop()
        queue.append(j)
    if rest is not None:
        inside = range(bisect_left(at, at[-1] - window), len(at) - 1)
        back[-1] = min(inside, key=lambda i: best[i] + rest(at[-1] - at[i]))
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Packs a stream of documents in their order. A run holds about BLOCK_TOKENS tokens or one document."""

    def __init__(self, ends: np.ndarray, task: int, window: int = WINDOW):
        self.ends, self.window, self.sequence = ends, window, task << 33
        self.docs: list[tuple] = []  # id, ids from `start` on, start, tokens of the document
        self.held = 0
        self.out: list[list] = [[] for _ in range(9)]

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append((doc_id, ids, 0, len(ids) // 4))
        self.held += len(ids) // 4
        if self.held >= BLOCK_TOKENS:
            self.run(last=False)

    def run(self, last: bool) -> None:
        if not self.docs:
            return
        ids = np.frombuffer(b"".join(d[1] for d in self.docs), "<u4")
        tops = np.cumsum([len(d[1]) // 4 for d in self.docs])
        cost = np.full(len(ids) + 1, -1, np.int64)
        at = np.flatnonzero(self.ends[ids]) + 1
        cost[at] = SENTENCE_CUT
        cost[tops] = 0
        cost[0] = 0
        offered = np.flatnonzero(cost >= 0)
        for k in np.flatnonzero(np.diff(offered) > HARD_GRID):
            cost[np.arange(offered[k] + HARD_GRID, offered[k + 1], HARD_GRID)] = HARD_CUT
        positions = np.flatnonzero(cost >= 0)
        end = functools.partial(rest_cost, window=self.window) if last else lambda length: 0  # what moves on costs nothing yet
        cuts = positions[cut_windows(positions, cost[positions], self.window, end)].tolist()
        done = cuts if last else cuts[:-1]
        if last and (rest := cuts[-1] - cuts[-2]).bit_count() > 1 and rest_cost(rest, self.window) < self.window - rest:
            for bit in reversed(range(rest.bit_length())):  # sequences as long as a power of two need no padding
                if rest >> bit & 1 and done[-2] + (1 << bit) < done[-1]:
                    done.insert(-1, done[-2] + (1 << bit))
        self.emit(done, tops)
        self.carry(done[-1], tops)

    def emit(self, cuts: list[int], tops: np.ndarray) -> None:
        doc, base = 0, 0
        for lo, hi in zip(cuts, cuts[1:]):
            at, total = lo, hi - lo
            while at < hi:
                while tops[doc] <= at:
                    base, doc = int(tops[doc]), doc + 1
                doc_id, ids, start, tokens = self.docs[doc]
                upto = min(hi, int(tops[doc]))
                part = memoryview(ids)[4 * (at - base) : 4 * (upto - base)]
                padded = total if total & (total - 1) == 0 else self.window
                for column, x in zip(self.out, (doc_id, start + at - base, upto - at, zlib.crc32(part), tokens, self.sequence, at - lo, total, padded)):
                    column.append(x)
                at = upto
            self.sequence += 1

    def carry(self, cut: int, tops: np.ndarray) -> None:
        first = int(np.searchsorted(tops, cut, "right"))
        left = self.docs[first:]
        if left:
            doc_id, ids, start, tokens = left[0]
            skip = cut - (int(tops[first - 1]) if first else 0)
            left[0] = (doc_id, ids[4 * skip :], start + skip, tokens)
        self.docs, self.held = left, int(tops[-1]) - cut

    def taken(self) -> list[list]:
        out, self.out = self.out, [[] for _ in range(9)]
        return out


def pack(docs: DataFrame, tokenizer_path: str = TOKENIZER, window: int = WINDOW) -> DataFrame:
    """Pack whole documents, in the order in which the table's splits hold them, into sequences of at most window ids.

    One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens,
    padded_to. A document is its text's ids (null: none) and END_OF_DOCUMENT; each id lies in one piece. Sequences do
    not reach over the input splits, so nothing is shuffled; a split's rest is cut into powers of two where that costs
    less than padding. Repeated rows and ids are packed again, each by itself; other columns are not looked at; no rows
    give no rows. A lost task packs its split again in the same way.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        encode = encoder(tokenizer_path)
        packer = Packer(sentence_ends(encode.tokenizer), TaskContext.get().partitionId(), window)

        def step(ids, texts):
            for doc_id, found in zip(ids, encode(texts)):
                packer.add(doc_id, found)
            return packer.taken()

        def end():
            packer.run(last=True)
            yield packer.taken()

        step.end = end
        return step

    return map_texts(docs, ["doc_id", "text"], f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_to long", make)
