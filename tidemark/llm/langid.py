"""Language identification by compression with per-language raw-content dictionaries."""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, filter_texts, id_remainder, map_texts

#: Labelled texts that a language's dictionary is made of: the bound on the sample it is fitted on.
TEXTS_PER_LANGUAGE = 96
#: Lengths of texts that are taken for a dictionary first; then shorter ones, then as much of longer ones.
TRAINING_CHARS = (200, 8_000)
DICTIONARY_BYTES = 110_000
#: Languages that are told apart at most, those with the most texts: the other bound on the sample.
LANGUAGES = 500
#: Dictionaries are of one size, the smallest language's, but not under this: a language with less has all that it has.
LEAST_BYTES = DICTIONARY_BYTES // 20
#: Texts are encoded in blocks, so that the dictionary and not the text's own past decides.
BLOCK_BYTES = 2_048
LEVEL = 9
#: A text is rejected if the runner-up's encoding is not longer by this share of its size.
MIN_MARGIN = 0.002
UNDETERMINED = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> bytes:
    """Lower-cased letters with single blanks between runs of them; what is encoded."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def fit(labelled: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> dict[str, bytes]:
    """Dictionaries from (text, lang) rows: of each language, the distinct texts with the smallest hashes.

    Rows whose lang is null, or whose text is or has no letter, are skipped. The driver gets per_language texts of bounded
    length of each of LANGUAGES languages at most.
    """
    low, high = TRAINING_CHARS
    n = F.length("text")
    fit_for = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    kind = F.when(n > high, 2).when(n < low, 1).otherwise(0)
    hashed = fit_for.select(F.substring("text", 1, high).alias("text"), "lang", kind.alias("kind"), F.xxhash64("text").alias("h"))
    distinct = checkpointed(hashed.groupBy("lang", "kind", "h").agg(F.count(F.lit(1)).alias("n")))
    largest = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("all")).orderBy(F.desc("all"), "lang").limit(LANGUAGES)
    counts = distinct.join(F.broadcast(largest), "lang").groupBy("lang", "kind").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "kind").collect()
    low_hash, left = F.lit(False), {r["lang"]: per_language for r in counts}
    for r in counts:  # of each language, kinds in order: hashes up to where about four times as many lie as are needed
        if left[r["lang"]] > 0:
            upto = min(int(-(2**63) + 2**64 * min(1.0, 4 * left[r["lang"]] / r["n"])), 2**63 - 1)
            low_hash = low_hash | ((F.col("lang") == r["lang"]) & (F.col("kind") == r["kind"]) & (F.col("h") <= F.lit(upto)))
            left[r["lang"]] -= r["n"]
    candidates = distinct.where(low_hash)
    chosen = candidates.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("kind", "h"))).where(F.col("r") <= per_language).select("lang", "h", "r")
    keys = {(r["lang"], r["h"]): r["r"] for r in chosen.collect()}
    if not keys:
        return {}
    wanted = F.col("h").isin(sorted({h for _, h in keys}))
    rows = hashed.where(wanted).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in rows:
        if (rank := keys.get((r["lang"], r["h"]))) is not None:
            texts.setdefault(r["lang"], []).append((rank, letters_only(r["text"])))
    least = min(sum(len(t) for _, t in own) for own in texts.values())
    share = min(DICTIONARY_BYTES, max(least, LEAST_BYTES))
    return {lang: b" ".join(t for _, t in sorted(own))[:share] for lang, own in sorted(texts.items())}


def encoders(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in dictionaries.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)))
    return out


def sizes(data: bytes, coders: list[tuple[str, zstandard.ZstdCompressor]]) -> list[int]:
    """Encoded size of the whole text by each language's dictionary."""
    blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
    return [sum(len(c.compress(b)) for b in blocks) for _, c in coders]


def predictor(dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN):
    """A function from a text to its language, score and whether it is rejected."""
    coders = encoders(dictionaries)

    def predict(text: str | None) -> tuple[str, float, bool]:
        data = letters_only(text) if text else b""
        if not data or not coders or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        found = sorted(zip(sizes(data, coders), range(len(coders))))
        margin = (found[1][0] - found[0][0]) / found[1][0] if len(found) > 1 else 1.0
        return coders[found[0][1]][0], margin, margin < min_margin

    return predict


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """Predict the language of each whole text.

    Returns doc_id, lang_pred, score (the runner-up's surplus as a share of its size, 0 to 1) and rejected (no letter,
    null, or a margin under min_margin). Null, empty and letterless texts: `und`, 0, rejected. Ties go to the first
    language by name. Repeated rows are all kept; other columns of docs are not looked at. Without dictionaries (no
    labelled text) every text is `und`. Texts of any length are encoded whole, block by block.
    """

    def make():
        predict = predictor(dictionaries, min_margin)
        return lambda ids, texts: [ids, *zip(*map(predict, texts))] if ids else None

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, ["doc_id", "text"], f"doc_id {kind}, lang_pred string, score double, rejected boolean", make)


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learn from documents whose id's remainder of 5 is not 0 and predict all: doc_id, held_out, lang_pred, score, rejected."""
    held = id_remainder(F.col("doc_id"), 5) == 0
    dictionaries = fit(docs.where(~held))
    return identify(docs.select("doc_id", "text"), dictionaries).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is told, with all their columns; the rejected go. Learns as identify_held_out does.

    Null, empty and letterless texts are rejected; repeated rows and rows without an id are judged each by their text; an
    empty table, or one without labels, leaves no rows.
    """
    dictionaries = fit(docs.where(id_remainder(F.col("doc_id"), 5) != 0))

    def make():
        predict = predictor(dictionaries)
        return lambda texts: [not predict(t)[2] for t in texts]

    return filter_texts(docs, make)
