import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def test_statistics(docs, odd):
    for row in docs.collect() + odd.collect():
        assert quality.statistics(row["text"])[:5] == brute(row["text"])


def test_learned_list_separates():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = ((x["a"] > 0.8) & (x["b"] < 0.5)) | (x["b"] > 0.9)
    rules = quality.learn(x, bad)
    said = np.zeros(3000, bool)
    for rule in rules:
        said |= quality.covered(rule, x, 3000)
    assert (said == bad).mean() > 0.97
    assert quality.learn(x, np.zeros(3000, bool)) == []


def test_the_emitted_conditional_says_what_the_rules_cover(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    measured = quality.with_statistics(docs.select("doc_id", "text"))
    rules = [(quality.Condition("n_words", True, 90.5), quality.Condition("upper_share", False, 0.04)), (quality.Condition("digit_share", True, 0.01),), (quality.Condition("mean_word", False, 5.0), quality.Condition("distinct_share", True, 0.9))]
    for own in (rules, rules[:1], [], quality.fit(measured, labels)):
        rows = measured.select(*(F.expr(e).cast("double").alias(f) for f, e in quality.FEATURES.items()), quality.verdict(own).alias("kept")).collect()
        x = {f: np.array([r[f] for r in rows], float) for f in quality.FEATURES}
        said = np.zeros(len(rows), bool)
        for rule in own:
            said |= quality.covered(rule, x, len(rows))
        assert [r["kept"] for r in rows] == (~said).tolist()


def test_judge(spark, small, odd):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.judge(docs, labels)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == docs.count()
    good = [r["kept"] for r in out.join(labels, "doc_id").where("quality = 1 and not base_failed").collect()]
    assert sum(good) >= 0.97 * len(good)
    assert all(not r["kept"] for r in rows.values() if r["base_failed"])
    assert quality.judge(odd, labels).count() == odd.count()
    assert quality.judge(odd, labels.limit(0)).count() == odd.count()
    assert quality.judge(odd.limit(0), labels).count() == 0
