import random
import re
from collections import Counter

from helixspark.llm.quality import score_quality, text_measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    w = WORD.findall(t or "")
    c = Counter(zip(w, w[1:], w[2:]))
    cov = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cov))


CASES = [None, "", " \n\t", "a", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "é ñ | <b> é ñ |",
         "no break \x0bvt", "w " * 5000, " ".join(str(i % 977) for i in range(20000))]


def test_measures_against_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(CASES)] + [(None, "a b c", "n"), (3, "a", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, w string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in text_measures(df).collect())
    assert got == sorted((i if i is not None else -1, *brute(t)) for i, t, _ in rows)


def test_posterior_rejects_junk_and_keeps_prose(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice(["lo", "ra", "mi", "ten", "sol"]) for _ in range(r.randint(1, 3)))
    rows = [(i, "\n".join(" ".join(r.choice(["the", "of", "and", word(), word()]) for _ in range(15)) + "." for _ in range(12)))
            for i in range(1, 80)]
    rows += [(1000 + i, " ".join(f"zx{j * i}### $$$ |" for j in range(60))) for i in range(1, 15)]
    out = {x.doc_id: x.p_good for x in score_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i] > 0.5 for i in range(1, 80)) and all(out[1000 + i] < 0.5 for i in range(1, 15))


def test_empty_table(spark):
    assert score_quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0
