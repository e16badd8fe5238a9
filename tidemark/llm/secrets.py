"""Secret scan: candidates by pattern, false positives removed by a random forest; DataFrame expressions throughout."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

#: Key characters, and a candidate: a run of them, with base64 padding where no value follows the signs.
KEY = "A-Za-z0-9+/_-"
CANDIDATE = f"[{KEY}]{{16,}}(?:={{1,2}}(?![={KEY}]))?"
#: A text is cut into blocks that end where no run goes on: of at most so many characters, or one longer run. What is done
#: in a block may cost the square of its candidates, a text as much as its blocks.
BLOCK_CHARS = 4_096
_BLOCK = f"(?s).{{0,{BLOCK_CHARS - 1}}}[^={KEY}]|.[={KEY}]*+"
#: Characters on either side that count as neighbouring words.
AROUND = 48
#: Labelled findings that the forest is trained on: the bound on its sample, taken by the smallest hashes.
FINDINGS = 3_600
TREES, MOST_DEPTH, LEAST_LEAF = 15, 6, 8
THRESHOLD = 0.5
#: Words of the learned dictionary.
WORDS = 200

#: Words whose presence in a candidate speaks for names and placeholders; and letter pairs, for want of texts.
DICTIONARY = (
    "example sample dummy test placeholder changeme change insert your here value default secret token password key none null true false "
    "main java python src lib bin org com net http https www index image static assets config docs readme version build release"
).split()
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()
_KEYWORD = r"(?i)(secret|token|password|passwd|pwd|api[_-]?key|auth|credential|private|access[_-]?key)[a-z_-]{0,12}[\"']?\s{0,3}[=:]\s{0,3}[\"']?$"
_ASSIGNED = r"[=:]\s{0,3}[\"']?$"
_PRETENDED = r"(?i)example(?!\.(com|org|net))|sample|dummy|placeholder|changeme|fake|xxx"
_TEST_PATH = r"(?i)(^|[/_.-])(tests?|examples?|fixtures?|docs?|samples?|mocks?)([/_.-]|$)"

FEATURES = ("chars", "digit_share", "upper_share", "class_changes", "pair_share", "dictionary_share", "distinct_share", "repeat_share", "separators", "hex", "keyword", "assigned", "pretended", "test_path")


def _upto(sizes: Column) -> Column:
    """For each element, the sum of those before it."""
    return F.transform(sizes, lambda x, i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, y: a + y))


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, candidate, before, after, path: each run of key characters with a digit, or assigned to a name.

    before and after are the AROUND characters on either side in the whole text, other candidates included. A text is
    cut into blocks first, so its length costs no more than in proportion.
    """
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    text = docs.select("doc_id", "text", F.coalesce(where, F.lit("")).alias("path")).where(F.col("text").rlike(f"[{KEY}]{{16,}}"))
    cut = text.select("doc_id", "path", F.regexp_extract_all("text", F.lit(_BLOCK), F.lit(0)).alias("blocks"))
    sized = cut.select("doc_id", "path", "blocks", F.transform("blocks", F.length).alias("sizes")).select("doc_id", "path", "blocks", _upto(F.col("sizes")).alias("upto"))
    # of two blocks in a row one is longer than AROUND, the text's last apart
    near = lambda i: F.coalesce(F.get("blocks", i), F.lit(""))
    block = F.transform(
        "blocks",
        lambda b, i: F.struct(
            F.get("upto", i).alias("at"), b.alias("text"), F.right(F.concat(near(i - 2), near(i - 1)), F.lit(AROUND)).alias("left"), F.left(F.concat(near(i + 1), near(i + 2)), F.lit(AROUND)).alias("right")
        ),
    )
    some = sized.select("doc_id", "path", F.explode(F.filter(block, lambda b: b["text"].rlike(f"[{KEY}]{{16,}}"))).alias("b"))
    found = some.select(
        "doc_id", "path", F.col("b.at").alias("at"), F.length("b.left").alias("skip"), F.concat("b.left", "b.text", "b.right").alias("around"),
        F.regexp_extract_all("b.text", F.lit(f"({CANDIDATE})"), F.lit(1)).alias("found"), F.split("b.text", CANDIDATE, -1).alias("between"),
    )
    # every candidate has width, so parts and candidates alternate
    reach = F.zip_with("found", F.slice("between", 1, F.size("found")), lambda c, x: F.length(c) + F.length(x))
    placed = found.select("doc_id", "path", "at", "skip", "around", "found", "between", _upto(reach).alias("upto"))
    each = F.transform("found", lambda c, k: F.struct((F.get("upto", k) + F.length(F.get("between", k))).alias("start"), c.alias("candidate")))
    one = placed.select("doc_id", "path", "at", "skip", "around", F.explode(each).alias("c")).select("doc_id", "path", "at", "around", (F.col("skip") + F.col("c.start")).alias("from"), "skip", F.col("c.candidate").alias("candidate"))
    out = one.select(
        "doc_id", (F.col("at") + F.col("from") - F.col("skip")).cast("long").alias("start"), "candidate",
        F.right(F.substring("around", F.greatest(F.col("from") - F.lit(AROUND - 1), F.lit(1)), F.least(F.col("from"), F.lit(AROUND))), F.lit(AROUND)).alias("before"),
        F.substring("around", F.col("from") + F.length("candidate") + 1, F.lit(AROUND)).alias("after"), "path",
    )
    return out.where(F.col("candidate").rlike("[0-9]") | F.col("before").rlike(_ASSIGNED))


@dataclass(frozen=True)
class Language:
    """Frequent letter pairs, and words, of the texts that are scanned."""

    pairs: tuple[str, ...] = tuple(PAIRS)
    words: tuple[str, ...] = ()


def language(docs: DataFrame, most_words: int = WORDS) -> Language:
    """Character transitions and a dictionary, learned from all texts, each whole: the pairs of letters that are likelier
    than if a letter's followers were all alike, and the commonest words of four letters and more. Pairs and words lie
    within runs of letters, so they are counted over the different runs. Without texts, fixed pairs and no words."""
    own = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{2,})"), F.lit(1))).alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("k"))
    runs = checkpointed(own)
    parts = lambda pattern, c: runs.select(F.explode(F.regexp_extract_all("r", F.lit(pattern), F.lit(1))).alias(c), "k").groupBy(c).agg(F.sum("k").alias("n"))
    pairs = parts("(?=([a-z][a-z]))", "p").collect()
    words = parts("([a-z]{4,16})", "w").where("n > 2")
    listed = tuple(sorted(r["w"] for r in words.orderBy(F.desc("n"), "w").limit(most_words).collect()))
    follows: dict[str, int] = {}
    for r in pairs:
        follows[r["p"][0]] = follows.get(r["p"][0], 0) + r["n"]
    likely = tuple(sorted(r["p"] for r in pairs if r["n"] * 26 > follows[r["p"][0]]))
    return Language(likely or tuple(PAIRS), listed)


def features(known: Language | None = None) -> list[Column]:
    """FEATURES of candidate, before, after, path as columns."""
    known = known or Language()
    c, n = F.col("candidate"), F.length("candidate").cast("double")

    def share(pattern: str, of: Column = c) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / n

    bare = F.regexp_replace(F.lower(c), "|".join(sorted({*DICTIONARY, *known.words}, key=lambda w: (-len(w), w))), "")
    around = F.concat_ws(" ", "before", "candidate", "after")
    flag = lambda x: x.cast("double")
    out = [
        n, share("[0-9]"), share("[A-Z]"), share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"), share(f"(?={'|'.join(known.pairs)})", F.lower(c)),
        (n - F.length(bare)) / n, F.size(F.array_distinct(F.split(c, ""))) / n, share(r"(.)\1"), share("[/_-]"), flag(c.rlike("^[0-9a-f]+$")),
        flag(F.col("before").rlike(_KEYWORD)), flag(F.col("before").rlike(_ASSIGNED)), flag(around.rlike(_PRETENDED)), flag(F.col("path").rlike(_TEST_PATH)),
    ]
    return [x.alias(name) for name, x in zip(FEATURES, out)]


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """candidate, before, after, path, secret: findings as reviewers label them, by public kinds of keys of many lengths,
    and by what is taken for keys: names, paths, numbers, placeholders, dates, digests, and keys in examples and tests."""
    rows = spark.range(n).select("id", F.expr("sha2(cast(id as string), 256)").alias("h"), F.expr("sha2(concat('k', id), 256)").alias("g"), F.expr("cast(id % 20 as int)").alias("kind"), F.expr("cast(id div 20 as int)").alias("v"))
    dense = "regexp_replace(base64(unhex(concat(h, g))), '[^A-Za-z0-9]', '')"
    syllables = "concat_ws('', transform(sequence(1, 7), i -> element_at(array('th','er','tion','ing','an','re','con','ment','able','ver'), cast(conv(substr(h, i * 3, 2), 16, 10) as int) % 10 + 1)))"
    digits = "lpad(cast(pmod(xxhash64(h), 10000000000000000) as string), 16, '4')"
    shown = {
        0: f"substr({dense}, 1, 24 + v % 17)", 1: "substr(concat(h, g), 1, 24 + 8 * (v % 6))", 2: f"concat(element_at(array('XKEY', 'ZAPI', 'QQID'), v % 3 + 1), upper(substr({dense}, 1, 14 + v % 9)))", 3: f"substr({dense}, 1, 43 + v % 20)",
        4: f"concat(element_at(array('xoxb-', 'glpat-', 'ya29_', 'npm_'), v % 4 + 1), substr({dense}, 1, 20 + v % 20))", 5: "upper(substr(h, 1, 18 + v % 30))", 6: f"concat({syllables}, cast(v % 2030 as string))", 7: "concat('your-api-key-here-', cast(v % 1000 as string))",
        8: digits, 9: f"concat('src/main/', substr({syllables}, 1, 12), '/v', v % 9, '/index')", 10: "concat('2024-', lpad(v % 12, 2, '0'), '-', lpad(v % 28, 2, '0'), '_10-20-30')", 11: "repeat(substr(h, 1, 2), 10)", 12: syllables,
        13: "substr(h, 1, 40)", 14: f"substr({dense}, 1, 40)", 15: f"concat('sk_live_', substr({dense}, 1, 24))", 16: "substr(concat(h, g), 1, 32 + 8 * (v % 5))", 17: f"concat(substr({syllables}, 1, 10), '_', substr({syllables}, 4, 9), '_id')",
        18: f"substr({dense}, 1, 18 + v % 30)", 19: f"substr({dense}, 1, 20 + v % 14)",
    }
    choice = lambda *of: f"element_at(array({', '.join(of)}), v % {len(of)} + 1)"
    before = {
        0: choice("'client_secret=\"'", "'auth: '", "'credential = '", "'api-key: '"), 1: choice("'access_token=\"'", "'private_key: '", "'passwd='", "'auth_token = \"'"), 2: choice("'use '", "'id '", "'or '"),
        3: choice("'secret: '", "'\"apiKey\": \"'", "'api_key = '"), 4: choice("'see '", "'bot '", "'auth='"), 5: choice("'pwd: '", "'secret = '", "'token='"), 6: "'of the '", 7: "'api_key = \"'", 8: choice("'card '", "'number: '", "'of '"),
        9: "'in '", 10: "'log '", 11: "'token = '", 12: choice("'type = '", "'and '", "'name: '"), 13: "'for example token = \"'", 14: "'secret_key = '", 15: "'stripe '", 16: choice("'commit '", "'md5: '", "'digest '", "'etag = '"),
        17: choice("'column = '", "'class '", "'key: '"), 18: choice("'and '", "'the '", "'with '"), 19: choice("'password = \"changeme or '", "'sample key '", "'dummy='"),
    }
    pick = lambda m: "case kind " + " ".join(f"when {k} then {e}" for k, e in m.items()) + " end"
    return rows.select(
        F.expr(pick(shown)).alias("candidate"), F.concat(F.lit("thing of "), F.expr(pick(before))).alias("before"), F.lit('" and so on').alias("after"),
        F.expr("case when kind = 14 then concat('tests/fixtures/a', id, '.py') when id % 3 = 0 then concat('app/mod', id % 20, '/settings.py') else '' end").alias("path"),
        F.expr("kind in (0, 1, 2, 3, 4, 5, 15, 18)").alias("secret"),
    )


# --- the forest -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    share: float
    feature: int = -1
    threshold: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def sql(self) -> str:
        if self.below is None:
            return f"{self.share:.6f}D"
        return f"case when {FEATURES[self.feature]} <= {self.threshold:.9f}D then {self.below.sql()} else {self.above.sql()} end"


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> Node:
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * LEAST_LEAF or share in (0.0, 1.0):
        return Node(share)
    best = (1e-9, -1, 0.0)
    for f in rng.choice(x.shape[1], size=int(np.ceil(np.sqrt(x.shape[1]))) + 1, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, p = x[order, f], np.cumsum(y[order])
        ends = np.flatnonzero(v[1:] != v[:-1])
        ends = ends[(ends + 1 >= LEAST_LEAF) & (len(y) - ends - 1 >= LEAST_LEAF)]
        if not len(ends):
            continue
        left = ends + 1.0
        right = len(y) - left
        a, b = p[ends] / left, (p[-1] - p[ends]) / right
        gain = share * (1 - share) - (left * a * (1 - a) + right * b * (1 - b)) / len(y)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), int(f), float((v[ends[k]] + v[ends[k] + 1]) / 2))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], _tree(x[low], y[low], rng, depth - 1), _tree(x[~low], y[~low], rng, depth - 1))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 7) -> list[Node]:
    """Trees over bootstrap samples, each split over a random choice of features by the fall in Gini impurity."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(trees):
        own = rng.integers(0, len(y), len(y))
        out.append(_tree(x[own], y[own].astype(float), rng, MOST_DEPTH))
    return out


def forest(spark: SparkSession, findings: DataFrame | None = None, known: Language | None = None) -> list[Node]:
    """A forest from labelled findings (candidate, before, after, path, secret): of more than FINDINGS those with the
    smallest hashes, so that the same findings give the same trees in whatever order they come."""
    rows = labelled_findings(spark) if findings is None else findings
    place = F.xxhash64("candidate", "before", "after", "path", "secret")
    first = rows.orderBy(place, "candidate", "before", "after", "path", "secret").limit(FINDINGS)
    got = first.select(*features(known), F.col("secret")).collect()
    return train(np.array([[r[f] for f in FEATURES] for r in got], float), np.array([r["secret"] for r in got], bool))


def scan(docs: DataFrame, path: str | None = None, trees: list[Node] | None = None, known: Language | None = None) -> DataFrame:
    """doc_id, start, length, candidate_sha256, score, is_secret of each candidate in the whole texts.

    score is the forest's mean share of secrets; is_secret is false for what it removes as a false positive. Null and
    empty texts have no candidates; repeated rows give repeated findings; a null path counts as empty; an empty table
    gives no rows; other columns are not looked at. Without trees, transitions and dictionary are learned from docs and
    the forest from labelled findings.
    """
    if trees is None:
        known = language(docs) if known is None else known
        trees = forest(docs.sparkSession, known=known)
    measured = candidates(docs, path).select("doc_id", "start", "candidate", *features(known))
    votes = F.expr("(" + " + ".join(t.sql() for t in trees) + f") / {len(trees)}")
    scored = measured.select("doc_id", "start", F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), F.round(votes, 6).alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)
