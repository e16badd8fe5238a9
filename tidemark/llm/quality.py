"""Quality rules: text statistics, and a learned decision list over them emitted as Spark conditionals."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, map_texts

#: Labelled rows that the list is learned from, about as many at most: those with the smallest hashes of their ids.
LABELLED_ROWS = 20_000
MIN_WORDS, REPEATED_PERCENT = 50, 50
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\v\f\r"

#: What the list's conditions may compare, in Spark SQL over the base statistics.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_distinct")


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    marked = np.zeros(len(words) + 2, bool)
    for i, w in enumerate(windows):
        if (j := first.setdefault(w, i)) != i:
            marked[i : i + 3] = True
            marked[j : j + 3] = True
    return int(marked.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """STATISTICS of a whole text; null counts as empty."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    blanks = len(data) - len(data.translate(None, _BLANKS))
    lines = [x for x in data.split(b"\n") if x.strip(_BLANKS)]
    letters = data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return (
        len(words), len(text or "") - blanks, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(data) - len(letters), len(data) - len(data.translate(None, b"0123456789")), len(set(words)),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, STATISTICS and base_failed of each row."""

    def make():
        def step(ids, texts):
            return [ids, *zip(*map(statistics, texts))] if ids else None

        return step

    counts = ", ".join(f"{s} long" for s in STATISTICS)
    found = map_texts(docs, ["doc_id", "text"], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}", make)
    return found.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEATED_PERCENT} * n_words"))


# --- learning -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.expr(FEATURES[self.feature])
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, most: int = 4) -> Rule:
    """Add the threshold with the best information gain until no good row is covered or nothing gains."""
    rule: Rule = ()
    inside = rows.copy()
    while len(rule) < most and (n0 := int((inside & ~bad).sum())):
        p0, best = int((inside & bad).sum()), (1e-9, None)
        for f, values in x.items():
            v, y = values[inside], bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            ends = np.flatnonzero(np.r_[v[1:] != v[:-1], False])
            if not len(ends):
                continue
            p = np.cumsum(y)[ends]
            n = ends + 1 - p
            for above in (False, True):
                pp, nn = (p0 - p, n0 - n) if above else (p, n)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p0 / (p0 + n0))), -np.inf)
                k = int(np.argmax(gains))
                if gains[k] > best[0]:
                    best = (float(gains[k]), Condition(f, above, float((v[ends[k]] + v[ends[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(x)
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> tuple[Rule, float]:
    """Drop last conditions while (p - n) / (p + n) on the pruning rows does not fall; with the precision there."""

    def worth(r: Rule) -> tuple[float, float]:
        inside = covered(r, x, len(bad)) & rows
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        return ((p - n) / (p + n), p / (p + n)) if p + n else (-1.0, 0.0)

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k])[0] >= worth(best)[0]:
            best = rule[:k]
    return best, worth(best)[1]


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 5, most_rules: int = 12, min_precision: float = 0.9) -> list[Rule]:
    """Sequential covering: rules for low quality in order, each grown on two thirds of the uncovered rows and pruned on
    the rest; ends when a pruned rule is not precise there or covers nothing new."""
    rng, left, rules = np.random.default_rng(seed), np.ones(len(bad), bool), []
    while len(rules) < most_rules and (left & bad).sum() >= 3:
        growing = rng.random(len(bad)) < 2 / 3
        rule = grow(x, bad, left & growing)
        if not rule:
            break
        rule, precision = prune(rule, x, bad, left & ~growing)
        inside = covered(rule, x, len(bad)) & left
        if precision < min_precision or not (inside & bad).any():
            break
        rules.append(rule)
        left &= ~inside
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional: false where the first matching rule says low quality."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = (F if out is None else out).when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(measured: DataFrame, labels: DataFrame, most_rows: int = LABELLED_ROWS) -> list[Rule]:
    """Rules from statistics and (doc_id, quality) labels. Null labels and ids are skipped; of several labels of a
    document the lowest holds. Fewer than two classes: no rules. Of more than most_rows labelled documents those whose
    ids' hashes lie in the lowest share are taken, so that about most_rows rows of numbers reach the driver."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = measured.join(marked, "doc_id")
    share = min(1.0, most_rows / max(joined.count(), 1))
    upto = min(int(-(2**63) + 2**64 * share), 2**63 - 1)
    rows = joined.where(F.xxhash64("doc_id") <= F.lit(upto)).select("quality", "doc_id", *(F.expr(e).cast("double").alias(f) for f, e in FEATURES.items())).collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), *(r[f] for f in FEATURES)))
    bad = np.array([r["quality"] < 1 for r in rows], bool)
    return learn({f: np.array([r[f] for r in rows], float) for f in FEATURES}, bad) if rows and bad.any() and not bad.all() else []


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of each row.

    Null and empty texts have no words and fail. Repeated rows stay. The statistics are of whole texts; they are
    written once to the shared folder, as the list is learned from them before it judges them.
    """
    measured = checkpointed(with_statistics(docs.select("doc_id", "text")))
    rules = fit(measured, labels.select("doc_id", "quality"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept")
    )
