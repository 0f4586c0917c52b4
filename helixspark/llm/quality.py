"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. The counts of vote
patterns (at most 3 ** rules, however large the corpus) are all that reaches the
driver; expectation-maximisation over them estimates the share of good documents and
each rule's accuracy, and the posterior P(good | votes) decides, so no single rule can
reject a document.

Cases: null text has no words; empty texts have zero counts and fail the base rule;
repeated rows give repeated rows; an empty table gives an empty result (the model then
keeps its starting values). Words are counted over the whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import SPACE, table, written

# Common function words of the four corpus languages.
FUNCTION_WORDS = (
    "the of and to in is that it was for on are with as by this be or an at from "
    "der die und in den von zu das mit ist des ein nicht sich auf "
    "de la le les et des en un une du que est pour dans qui par "
    "el los las y se del por con una para no su al lo"
).split()


def text_measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over the whole text, one row per input row.

    ``n_repeat_words`` finds 3-word windows by a 64-bit hash: hashes are sorted as plain
    longs first, and only documents in which two are equal pay for the positions.
    """
    d = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.select("doc_id", "t", F.array_remove(F.split("t", f"[{SPACE}]+"), "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"))
    words = F.col("w")
    d = d.select(
        "doc_id", "w", "lines", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_bang"),
        F.transform(F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                    lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))).alias("h"))
    d = d.withColumn("s", F.sort_array("h"))
    s, h = F.col("s"), F.col("h")
    twice = F.exists(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.get(s, i) == F.get(s, i - 1))
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.withColumn("p", F.when((F.size("s") > 1) & twice, pairs))
    p = F.col("p")
    hit = F.filter(p, lambda e, i: F.coalesce(e["h"] == F.get(p, i - 1)["h"], F.lit(False))
                   | F.coalesce(e["h"] == F.get(p, i + 1)["h"], F.lit(False)))
    at = F.sort_array(F.transform(hit, lambda e: e["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_bang",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("lines", lambda x: x.rlike(f'[.!?:;"][{SPACE}]*$'))).cast("long").alias("n_ended_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(FUNCTION_WORDS))).cast("long").alias("n_function_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0)).cast("int")


def rules() -> dict[str, Column]:
    """Votes over the columns of ``text_measures``. Ratios are per word or per line."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    ln = F.greatest(F.col("n_lines"), F.lit(1))
    mean = F.col("word_chars") / n
    sym, bang = F.col("n_symbols") / n, F.col("n_bang") / n
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    rep, dup = F.col("n_repeat_words") / n, F.col("n_dup_lines") / ln
    fun, end = F.col("n_function_words") / n, F.col("n_ended_lines") / ln
    return {
        "length": _vote(F.col("n_words") >= 100, F.col("n_words") < 20),
        "word_size": _vote(mean.between(3.5, 8.0), (mean < 2.5) | (mean > 12.0)),
        "symbols": _vote(sym < 0.02, sym > 0.1),
        "shouting": _vote((upper < 0.1) & (bang < 0.02), (upper > 0.4) | (bang > 0.2)),
        "repeats": _vote(rep < 0.1, rep > 0.35),
        "line_copies": _vote(dup < 0.05, (dup > 0.3) & (F.col("n_dup_lines") >= 3)),
        "function_words": _vote(fun > 0.12, fun < 0.04),
        "line_ends": _vote(end > 0.8, end < 0.3),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and per rule P(vote | good) and P(vote | bad)."""

    prior: float
    accuracy: dict[str, tuple[dict[int, float], dict[int, float]]]

    def posterior(self) -> Column:
        """P(good | votes) over vote columns named as the rules."""
        score = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, (good, bad) in self.accuracy.items():
            up, down, none = (math.log(good[v] / bad[v]) for v in (1, -1, 0))
            score = score + F.when(F.col(name) > 0, up).when(F.col(name) < 0, down).otherwise(none)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit_votes(votes: DataFrame, names: list[str], iterations: int = 100) -> VoteModel:
    """EM over the table of vote patterns.

    Each rule has its own accuracy on good and on bad documents, so a rarely cast bad vote
    weighs more than a good vote that nearly every document gets. It starts from
    "good unless a rule objects" (0.9 or 0.2), and pseudo-counts that put 8 of 10 votes
    right keep a rule's direction where the data say little.
    """
    patterns = [(tuple(r[n] for n in names), r["n"])
                for r in votes.groupBy(*names).agg(F.count("*").alias("n")).collect()]
    post = [0.2 if min(v) < 0 else 0.9 for v, _ in patterns]
    start = ({1: 8.0, 0: 1.0, -1: 1.0}, {1: 1.0, 0: 1.0, -1: 8.0})
    prior, acc = 0.5, {}
    for _ in range(iterations):
        tables = [tuple(dict(t) for t in start) for _ in names]
        good = total = 0.0
        for (v, n), p in zip(patterns, post):
            good, total = good + n * p, total + n
            for j, x in enumerate(v):
                tables[j][0][x] += n * p
                tables[j][1][x] += n * (1 - p)
        prior = min(0.99, max(0.01, good / total)) if total else 0.5
        acc = {name: tuple({v: c / sum(t.values()) for v, c in t.items()} for t in pair)
               for name, pair in zip(names, tables)}
        post = []
        for v, _ in patterns:
            z = math.log(prior / (1 - prior)) + sum(math.log(acc[m][0][x] / acc[m][1][x]) for m, x in zip(names, v))
            post.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
    return VoteModel(prior, acc)


def score_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, one vote column per rule and ``p_good`` per input row. The measures are
    written once, so the texts are read a single time for both the fit and the result."""
    measures = text_measures(df, id_col, text_col)
    votes = rules()
    v = written(measures.select("*", *[c.alias(n) for n, c in votes.items()]), "quality")
    return v.withColumn("p_good", fit_votes(v, list(votes)).posterior())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = score_quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & (F.col("p_good") >= 0.5)).alias("kept"),
                    F.round("p_good", 9).alias("p_good"))
