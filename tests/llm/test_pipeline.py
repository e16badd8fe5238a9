import random

import pytest
import zstandard

import corpus_pipeline
from tidemark.llm import decontam, langid, packing, pii, simhash
from tidemark.llm.common import id_remainder, table

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, small):
    """What each stage but the last is given and returns, as rows."""
    docs = table(spark, small, "documents")
    out, rows = {}, docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, spark.createDataFrame(rows, docs.schema).repartition(5), small)
        assert frame.columns == docs.columns, name
        after = frame.collect()
        out[name] = (rows, after)
        rows = after
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_language_stage_by_brute_force(spark, docs, steps):
    before, after = steps["language"]
    dictionaries = langid.fit(docs.where(id_remainder(docs["doc_id"], 5) != 0))

    def sizes(data):
        for content in dictionaries.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(dict_data=held, level=langid.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            yield sum(len(coder.compress(data[i : i + langid.BLOCK_BYTES])) for i in range(0, len(data), langid.BLOCK_BYTES))

    want = []
    for r in before:
        if data := langid.letters_only(r["text"] or ""):
            low, second = sorted(sizes(data))[:2]
            want += [r["doc_id"]] * ((second - low) / second >= langid.MIN_MARGIN)
    assert ids(after) == sorted(want) and 0.9 * len(before) < len(after)


def test_near_duplicate_stage_by_brute_force(steps):
    before, after = steps["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert len(texts) == len(before)
    word = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} for i, w in word.items()}
    prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    order = sorted(texts)
    for k, a in enumerate(order):
        for b in order[:k]:
            common = len(sets[a] & sets[b])
            if word[a] == word[b] or (prints[a] ^ prints[b]).bit_count() <= 2 or common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert ids(after) == sorted({root(i) for i in texts}) and len(after) < len(before)


def test_decontamination_stage_by_brute_force(spark, small, steps):
    from tests.llm.test_decontam import brute_tiles

    before, after = steps["decontamination"]
    items = [t for r in table(spark, small, "benchmark").collect() if (t := decontam.tokens(r["text"]))]
    want = []
    for r in before:
        doc = decontam.tokens(r["text"])
        seeds = {n: {tuple(doc[k : k + n]) for k in range(len(doc) - n + 1)} for n in range(1, 6)}
        bad = False
        for item in items:
            n = min(5, len(item))
            shared = [any(tuple(item[j : j + n]) in seeds[n] for j in range(max(0, k - n + 1), min(k, len(item) - n) + 1)) for k in range(len(item))]
            if sum(shared) >= 0.5 * len(item):  # else no tiles can reach the threshold
                kept = {t for k in range(len(item) - n + 1) if tuple(item[k : k + n]) in seeds[n] for t in item[k : k + n]}
                places = [t if t in kept else None for t in doc]
                squeezed = [t for k, t in enumerate(places) if t is not None or (k and places[k - 1] is not None)]
                bad |= brute_tiles(item, squeezed, n) >= 0.5 * len(item)
        want += [] if bad else [r["doc_id"]]
    assert ids(after) == sorted(want) and len(after) < len(before)


def test_personal_data_stage_by_brute_force(steps):
    before, after = steps["personal_data"]
    tagger, texts = pii.trained(), {r["doc_id"]: r["text"] for r in after}
    assert ids(before) == ids(after)
    for r in before:
        (base, every), shown, at = pii.find([r["text"]], tagger)[0], [], 0
        assert set(base) <= set(every)
        for a, b, kind in every:
            if a >= at:
                shown += [r["text"][at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        assert texts[r["doc_id"]] == "".join(shown) + r["text"][at:]
    assert all(not pii.base_spans(t) for t in texts.values()) and any("[EMAIL]" in t for t in texts.values())


def test_packing_stage_is_a_round_trip(spark, small, steps, docs):
    _, rows = steps["personal_data"]
    pieces = STAGES["packing"](spark, spark.createDataFrame(rows, docs.schema).repartition(4), small).collect()
    encode = packing.Encoder(packing.TOKENIZER).tokenizer.encode
    length = {r["doc_id"]: len(encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows}
    ends = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert ends.get(p["doc_id"], 0) == p["start"] and p["doc_tokens"] == length[p["doc_id"]]
        ends[p["doc_id"]] = p["start"] + p["length"]
    assert ends == length


def test_stages_take_odd_rows(spark, small, odd):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice(["le", "que", "ment", "ion", "eau"]) for _ in range(3)) for _ in range(60))
    rows = [(None, text(), "fr"), (None, text(), "fr"), (1, text(), "fr"), (1, text(), "fr"), (2, None, None), (3, "", "fr")]
    named = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as key_1", "2 as mark", "3 as tid", "'s' as source", "5L as n_chars")
    for frame in (odd, named, odd.limit(0), named.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, small)
            assert frame.count() >= 0, name
    kept = STAGES["near_duplicates"](spark, named, small)
    assert kept.columns == named.columns and kept.count() == 5


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.where("offset = 0").count() == out.select("sequence_id").distinct().count()
