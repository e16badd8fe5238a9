import random

import zstandard

from tidemark.llm import langid


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and not rejected").collect()
    assert len(out) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.95


def test_odd_rows(spark, odd):
    out = langid.identify_held_out(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = spark.createDataFrame([(1, None), (2, "123 !!"), (3, "words")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(none, {"aa": b"some words here", "bb": b"andere Worte hier"}).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["rejected"]
    assert got[3]["lang_pred"] == "aa"
    assert langid.identify(none, {}).where("lang_pred = 'und'").count() == 3
    assert langid.keep_identified(odd.limit(0)).count() == 0


def test_sizes_cover_the_whole_text():
    coders = langid.encoders({"aa": b"some words here " * 20, "bb": b"andere Worte " * 20})
    short, long = langid.sizes(b"some words here", coders), langid.sizes(b"some words here" + b" qzx" * 5000, coders)
    assert long[0] > short[0] and short[0] < short[1]


def test_short_and_long_texts_are_learned_too(spark):
    rows = [(1, "the cat", "aa"), (2, "die Katze", "bb"), (3, None, "cc"), (4, "12", "dd"), (5, "le chat noir " * 2000, "ee")]
    assert set(langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))) == {"aa", "bb", "ee"}


def test_a_small_language_is_not_drowned(spark):
    """A language of a few hundred bytes against one of many thousands: dictionaries of like size, both told."""
    rng = random.Random(2)
    big = ["ka", "lo", "mi", "tu", "ne", "so", "ra", "pe"]
    text = lambda of, n: " ".join("".join(rng.choice(of) for _ in range(rng.randint(1, 3))) for _ in range(n))
    small = ["xy", "zu", "qe", "vo", "wix", "jaz"]
    rows = [(text(big, 400), "aa") for _ in range(120)] + [(text(small, 60), "bb")]
    dictionaries = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(dictionaries["aa"]) == langid.LEAST_BYTES and 100 < len(dictionaries["bb"]) < 1000
    predict = langid.predictor(dictionaries)
    assert [predict(text(big, 50))[0] for _ in range(20)] == ["aa"] * 20
    assert sum(predict(text(small, 50))[0] == "bb" for _ in range(20)) >= 19


def test_predictions_match_plain_compression():
    """Sizes and margins by zstandard alone, without the operator's coders."""
    dictionaries = {"aa": b"ka lo mi tu ne so ra pe kalo mitu " * 30, "bb": b"xy zu qe vo wix jaz zuqe vowix " * 30}
    for text in ("Kalo mitu, ne 12 so!", "zuqe vowix jaz", "ka xy", "mi" * 4000):
        data = langid.letters_only(text)
        size = {}
        for lang, content in dictionaries.items():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(dict_data=held, level=langid.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            size[lang] = sum(len(coder.compress(data[i : i + langid.BLOCK_BYTES])) for i in range(0, len(data), langid.BLOCK_BYTES))
        low, high = sorted(size.values())
        lang, score, rejected = langid.predictor(dictionaries)(text)
        assert size[lang] == low and abs(score - (high - low) / high) < 0.02 and rejected == ((high - low) / high < langid.MIN_MARGIN)
