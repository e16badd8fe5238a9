import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lm


def test_base_scores_match_brute_force(docs):
    rows = {r["doc_id"]: r for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    split = {i: lm.words(r["text"]) + [lm.END_WORD] for i, r in rows.items()}
    counts = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    out = lm.score_held_out(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        ws = split[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(ws) and r["train_tokens"] == total
        assert r["n_known"] == sum(w in counts for w in ws)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0


def test_rare_words_through_the_join_give_the_same(docs):
    a = {r["doc_id"]: r for r in lm.score(docs, docs, sent_words=5).collect()}
    b = {r["doc_id"]: r for r in lm.score(docs, docs, sent_words=10**6).collect()}
    for i, r in a.items():
        assert r["n_known"] == b[i]["n_known"] and math.isclose(r["base_score"], b[i]["base_score"], rel_tol=1e-9)


def streams(texts):
    """For each word, and the end, its bytes between blanks: [(start blank and bytes before, byte), ...]."""
    out = []
    for text in texts:
        for w in [*lm.words(text), None]:
            shown = b" " + (lm.END_BYTE if w is None else w + b" ")
            out.append([(shown[:i], shown[i]) for i in range(1, len(shown))])
    return out


def brute_tree(texts, least):
    """The same tree by dictionaries: p(byte | bytes before it in the word)."""
    follows = {}
    for word in streams(texts):
        for before, x in word:
            for n in range(len(before) + 1):
                follows.setdefault(before[len(before) - n :], Counter())[x] += 1
    memo, open_ = {}, {}

    def entropy(c):
        total = sum(follows[c].values())
        return -sum(n * math.log(n / total) for n in follows[c].values())

    def there(c):
        """Whether the context is looked at: frequent, and its suffix one that may be refined."""
        if c not in open_:
            open_[c] = not c or (sum(follows.get(c, {}).values()) >= least and there(c[1:]) and (len(c) == 1 or entropy(c[1:]) >= lm.MIN_DIVERGENCE))
        return open_[c]

    def dist(c):
        if c not in memo:
            own, total = follows[c], sum(follows[c].values())
            base = dist(c[1:]) if c else dict.fromkeys(range(256), 1 / 256)
            far = sum(n * math.log(n / total / base[x]) for x, n in own.items())
            memo[c] = {x: (own[x] + len(own) * base[x]) / (total + len(own)) for x in range(256)} if not c or far >= lm.MIN_DIVERGENCE else base
        return memo[c]

    def log10(word):
        out = 0.0
        for before, x in word:
            while not there(before):
                before = before[1:]
            out += math.log10(dist(before)[x])
        return out

    return log10


def whole(text):
    """The same of a text as a whole: all before a byte is its context."""
    line = b" " + b"".join(w + b" " for w in lm.words(text)) + lm.END_BYTE
    return [(line[:i], line[i]) for i in range(1, len(line))]


def sentences(rng, n):
    """Texts in which a word's ending, and the word before, tell much of the next."""
    after = {"the": ["cat", "dog", "end"], "cat": ["sat", "ran"], "dog": ["ate", "the"], "sat": ["by"], "ran": ["by", "the"], "ate": ["über"], "by": ["the"], "über": ["the"], "end": ["the", "ate"]}
    for _ in range(n):
        own = ["the"]
        while rng.random() < 0.95:
            own.append(rng.choice(after[own[-1]]))
        yield "  ".join(own).title() + rng.choice(["", " \n", "\t"])


@pytest.mark.parametrize("few", [0, 0.5])
def test_contexts_reach_over_words_as_in_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(lm, "LEAST_COUNT", 8)
    monkeypatch.setattr(lm, "MIN_DIVERGENCE", 20.0)
    monkeypatch.setattr(lm, "CONTEXT_SHARE", 10**6)
    monkeypatch.setattr(lm, "FEW", few)
    texts = [*sentences(random.Random(7), 40), "", None]
    monkeypatch.setitem(globals(), "streams", lambda ts: [whole(t) for t in ts])
    log10 = brute_tree(texts, 8)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "ran by the cat sat", "the the zoo by"])], "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in lm.score(docs, docs.where(f"doc_id < {len(texts)}")).collect()}
    for r in docs.collect():
        assert math.isclose(out[r["doc_id"]]["score"], log10(whole(r["text"])), rel_tol=1e-5), r


def test_learning_reads_the_texts_a_few_times_whatever_the_length_of_contexts(spark):
    rng, start = random.Random(3), "a passage that many texts share, word by word, and that goes on for long "
    texts = [(start * 2 + rng.choice(["one", "two", "six"]) + " end",) for _ in range(300)]
    by_word = lm.counts(spark.createDataFrame(texts, "text string"))
    group, tracker = "lm-jobs", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)
    tree = lm.grow(spark.createDataFrame(texts, "text string").repartition(3), lm.text_symbols, lm.symbols_of(by_word))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tree.depth > 5 and len(tracker.getJobIdsForGroup(group)) < 40


def test_a_word_depends_on_the_one_before(spark):
    texts = [("alpha beta gamma delta " * 5,), ("delta gamma alpha beta",)] * 5
    asked = spark.createDataFrame([(1, "alpha beta gamma delta " * 10), (2, "beta alpha delta gamma " * 10)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in lm.score(asked, spark.createDataFrame(texts, "text string")).collect()}
    assert math.isclose(out[1]["base_score"], out[2]["base_score"]) and out[1]["score"] > out[2]["score"] + 5


def test_tree_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEAST_COUNT", 3)
    monkeypatch.setattr(lm, "CONTEXT_SHARE", 10**6)
    rng = random.Random(4)
    syllables = ["an", "ter", "ion", "é", "sch", "qu", "a", "the"]
    text = lambda n: " ".join("".join(rng.choice(syllables[: rng.randint(2, 8)]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    texts = [text(rng.randint(0, 80)) for _ in range(60)]
    by_word = lm.counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    tree = lm.learn(by_word)
    assert tree.depth >= 4
    log10 = brute_tree(texts, 3)
    asked = [*texts[:20], "unseen wörds ΣΑΣ the", "an" * 40, ""]
    for t in asked:
        own = [*lm.words(t), lm.END_WORD]
        assert np.allclose(tree.log10(own), [log10(w) for w in streams([t])], atol=1e-4)
    # all words of up to two letters, and the rest: probabilities of words add up to no more than one
    letters = [bytes([x]) for x in range(33, 127)]
    assert 0.01 < sum(10.0 ** tree.log10([*letters, *(a + b for a in letters for b in letters)])) < 1


def test_tree_beats_a_second_order_model_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang in ('en', 'fr') and n_chars < 20000")
    scored = {r["doc_id"]: r for r in lm.score_held_out(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order2, seen = {}, Counter()
    line = lambda t: b"  " + b" ".join(lm.words(t)) + b" " + lm.END_BYTE
    for i, t in texts.items():
        if not scored[i]["held_out"]:
            s = line(t)
            for k in range(2, len(s)):
                order2.setdefault(s[k - 2 : k], Counter())[s[k]] += 1
                seen[s[k]] += 1
    total = sum(seen.values())
    low = {x: (seen[x] + 1 / 256) / (total + 1) for x in range(256)}

    def second(t):
        s, out = line(t), 0.0
        for k in range(2, len(s)):
            own = order2.get(s[k - 2 : k], Counter())
            out += math.log10((own[s[k]] + len(own) * low[s[k]]) / (sum(own.values()) + len(own))) if own else math.log10(low[s[k]])
        return out

    held = [i for i in texts if scored[i]["held_out"]]
    chars = sum(len(line(texts[i])) - 2 for i in held)
    bits = lambda x: -x / math.log10(2) / chars
    ours, theirs = bits(sum(scored[i]["score"] for i in held)), bits(sum(second(texts[i]) for i in held))
    print(f"bits a byte of held-out text: tree {ours:.3f}, second order {theirs:.3f}")
    assert len(held) > 50 and ours < theirs


def test_places():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    places = lm._Places(keys)
    assert (places(keys) == np.arange(len(keys))).all() and (places(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
    assert len(lm._Places(keys[:0])(keys[:3])) == 3


def test_odd_rows(odd, spark):
    out = lm.score_held_out(odd).collect()
    assert len(out) == odd.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in out)
    assert all(math.isfinite(r["score"]) for r in lm.score(odd, odd.limit(0)).collect())
    assert lm.score_held_out(odd.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.25, 0.5, 0.75])
def test_contexts_frequent_in_one_chunk_alone_are_not_counted(spark, monkeypatch, share):
    """All contexts that are frequent in all are sought out, with their suffixes, and no others than by the bound."""
    monkeypatch.setattr(lm, "TOLD_SHARE", share)
    rng, least = random.Random(5), 60
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    common, own = [word(5) for _ in range(6)], [[word(5) for _ in range(6)] for _ in range(8)]
    texts = [" ".join(rng.choice(common if rng.random() < 0.5 else own[k]) for _ in range(60)) for k in range(8) for _ in range(2)]
    strings = spark.createDataFrame([(t,) for t in texts], "text string").repartitionByRange(8, "text").select("text")
    times = Counter()
    for t in texts:
        line = b" " + b"".join(w + b" " for w in lm.words(t)) + lm.END_BYTE
        for i in range(1, len(line)):
            for n in range(1, min(i, 15) + 1):
                times[line[i - n : i]] += 1
    n_all = sum(len(t) + 2 for t in texts)
    lengths, start, prefix, _ = lm.mine(strings, lm.text_symbols, 0, lm.FIRST_WIDTHS, np.zeros(1, np.uint64), n_all, least)
    trie = lm._Trie(0, lm.FIRST_WIDTHS, np.zeros(1, np.uint64), lengths, start, prefix)
    got = np.concatenate(trie.context)

    def hashed(context):
        return sum((b + 1) * pow(lm._BASE, k, 2**64) for k, b in enumerate(reversed(context), 1)) % 2**64

    frequent, scarce = ({hashed(c) for c, n in times.items() if wanted(n)} for wanted in (lambda n: n >= least, lambda n: n < (1 - share) * least - 1))
    assert len(set(got.tolist())) == len(got) and frequent <= set(got.tolist()) and not scarce & set(got.tolist())
    assert set(np.concatenate(trie.suffix).tolist()) <= set(got.tolist()) | {0}


def test_counts_are_handed_on_before_they_are_too_many(spark, monkeypatch):
    texts = [(t,) for t in sentences(random.Random(9), 60)]
    strings = spark.createDataFrame(texts, "text string").repartition(2)
    monkeypatch.setattr(lm, "CHUNK", 512)
    n = lm.symbols_of(lm.counts(strings))
    once = [tuple(x.tolist() for x in rows) for rows in lm.longer(strings, lm.text_symbols, 0, lm.FIRST_WIDTHS, np.zeros(1, np.uint64), n, 8)]
    monkeypatch.setattr(lm, "MOST_SEEN", 2000)
    assert once == [tuple(x.tolist() for x in rows) for rows in lm.longer(strings, lm.text_symbols, 0, lm.FIRST_WIDTHS, np.zeros(1, np.uint64), n, 8)]


def test_deep_contexts_of_a_batch_are_looked_up_together(spark, monkeypatch):
    """Whatever the blocks are, scores are the same, and a deep tree takes no step a length for each block."""
    rng, start = random.Random(6), "a passage that many texts share, word by word, and that goes on for long "
    texts = [start * 3 + rng.choice(["one", "two", "six"]) + " end" for _ in range(300)]
    strings = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    tree = lm.grow(strings, lm.text_symbols, lm.symbols_of(lm.counts(strings)))
    asked = [lm.shown(lm.words(t)) for t in [*texts, "", "other words"]]
    whole = tree.of(asked)
    assert tree.depth > 2 * lm.NEAR_LENGTHS
    lookups, size = [], tree.child.size

    class Seen(np.ndarray):
        def __getitem__(self, key):
            lookups.extend([1] * (self.size == size))
            return super().__getitem__(key)

    monkeypatch.setattr(lm, "BLOCK", 1000)
    tree.child = tree.child.view(Seen)
    assert np.array_equal(tree.of(asked), whole)
    blocks = -(-sum(map(len, asked)) // 1000)
    assert len(lookups) <= blocks * lm.NEAR_LENGTHS + tree.depth
    for near, at_once in ((3, 777), (5, 1 << 20), (10**6, 1 << 12)):
        monkeypatch.setattr(lm, "NEAR_LENGTHS", near)
        monkeypatch.setattr(lm, "SCORED_AT_ONCE", at_once)
        assert np.allclose(tree.of(asked), whole, rtol=1e-12)


@pytest.mark.parametrize("few", [0, 0.5])
def test_many_small_partitions_do_not_make_rare_contexts_told(spark, monkeypatch, few):
    """A chunk's share of a frequent context must not come down to one: small partitions are read together."""
    monkeypatch.setattr(lm, "FEW", few)
    rng, start = random.Random(8), "a passage that many texts share, word by word, and that goes on for long "
    strings = spark.createDataFrame([(start * 2 + rng.choice(["one", "two", "six"]) + " end",) for _ in range(240)], "text string")
    n, mine, chunks = lm.symbols_of(lm.counts(strings)), lm._mine, []

    def noted(*args):
        rows = mine(*args)
        chunks.append(int(rows[3][rows[0] < 0].sum()))
        return rows

    monkeypatch.setattr(lm, "_mine", noted)
    trees = [lm.grow(strings.repartition(k), lm.text_symbols, n) for k in (1, 60)]
    assert len(chunks) > 2 and set(chunks) == {1}
    asked = [lm.shown(lm.words(r["text"])) for r in strings.limit(9).collect()]
    assert np.array_equal(*(tree.of(asked) for tree in trees))


@pytest.mark.parametrize("most", [1 << 20, 400, 0])
def test_an_automaton_tells_the_longest_context_before_each_symbol(monkeypatch, most):
    monkeypatch.setattr(lm, "STRETCH", 7)
    rng = random.Random(2)
    text = bytes(rng.choice(b"abc \xff\xfe") for _ in range(400))
    known = {w[k:] for w in (bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 6))) for _ in range(40)) for k in range(len(w))}
    hashed = lambda c: sum((b + 1) * pow(lm._BASE, k, 2**64) for k, b in enumerate(reversed(c), 1)) % 2**64
    by_length = [[c for c in known if len(c) == k] for k in range(1, 7)]
    levels = [(np.array([hashed(c) for c in own], np.uint64), np.array([hashed(c[1:]) for c in own], np.uint64), np.array([c[0] for c in own])) for own in by_length]
    column = np.full(256, 4, np.int32)
    column[list(b"abc ")] = range(4)
    steps = lm._Steps(levels, column, 5, most)
    assert steps.depth == {1 << 20: 6, 400: steps.depth, 0: 0}[most] and steps.size * 5 <= max(most, 5) and (most != 400 or 0 < steps.depth < 6)
    state_of = {c: s for own, states in zip(by_length, steps.states) for c, s in zip(own, states.tolist())}
    longest = {s: c for c, s in state_of.items()}
    for start in (0, 3, 100):
        for i, at in enumerate(steps(np.frombuffer(text, np.uint8), start).tolist(), start):
            state, own = divmod(at, 5)
            assert own == column[text[i]]
            while state and state not in longest:
                state = int(steps.suffix[state])
            want = max((text[i - k : i] for k in range(min(i, steps.depth) + 1) if not k or text[i - k : i] in known), key=len)
            assert longest.get(state, b"") == want


def test_counts_and_scores_are_the_same_without_an_automaton(spark, monkeypatch):
    texts = [(t,) for t in sentences(random.Random(11), 80)]
    strings = spark.createDataFrame(texts, "text string").repartition(2)
    n, asked = lm.symbols_of(lm.counts(strings)), [lm.shown(lm.words(t)) for (t,) in texts]
    out = []
    for most in (1 << 24, 0):
        monkeypatch.setattr(lm, "MOST_STEPS", most)
        rows = [tuple(x.tolist() for x in own) for own in lm.longer(strings, lm.text_symbols, 0, lm.FIRST_WIDTHS, np.zeros(1, np.uint64), n, 8)]
        tree = lm.grow(strings, lm.text_symbols, n)
        out.append((rows, tree.steps.depth > 0, tree.of(asked).tolist()))
    assert out[0][0] == out[1][0] and out[0][1] and not out[1][1] and out[0][2] == out[1][2]


def test_tokens_are_the_words_and_the_end():
    texts = [None, "", " \n\t ", "word", " One  two\tTWO.", "über naïve\x1cñandú \x0b á"]
    ((data, _),) = lm.text_symbols(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    start, size = lm._tokens(data)
    wanted = [w for t in texts for w in [*lm.words(t), lm.END_WORD]]
    assert lm._cut(data, start, size).to_pylist() == wanted
    hashes = lm._token_hashes(data, start, size).tolist()
    assert len(set(zip(wanted, hashes))) == len(set(wanted)) == len(set(hashes))
