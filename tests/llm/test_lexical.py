import math
import random
import re
from collections import Counter

from helixspark.llm.lexical import ranked_search, share
from helixspark.llm.topk import first_rows
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(t):
    return [x.translate(FOLD) for x in TERM.findall(t or "")]


def brute(docs, items, k):
    texts = [(i, Counter(terms(t))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    n_docs, total = len(texts), sum(n for _, _, n in texts)
    asked = {}
    for q, t in items:
        asked.setdefault(q, set()).update(terms(t))
    out = set()
    for q, ts in asked.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in texts) + 1))) for t in ts}
        found = []
        for i, c, n in texts:
            m = 100 - 50 + (50 * n * n_docs) // total
            s = sum(w[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out |= {(q, r, None if x else i, -s) for r, (s, x, i) in enumerate(sorted(found)[:k], 1)}
    return out


def run(spark, docs, items, k=50, **kw):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string")
    q = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id int, text string, q string")
    rows = [tuple(r) for r in ranked_search(d, q, k, **kw).select("item_id", "rank", "doc_id", "score").collect()]
    assert set(rows) == brute(docs, items, k) and len(rows) == len(set(rows))
    return rows


def test_small_cases(spark):
    docs = [(1, "Ab_c é9 AB"), (2, None), (3, ""), (4, "--- !"), (5, "éÉ ab x1"), (None, "ab"), (5, "ab"), (7, "z" * 5000), (2**60, "ab ab")]
    items = [(1, "AB"), (2, ""), (3, None), (4, "é9 É éÉ"), (1, "x1"), (9, "nothing of this"), (None, "ab")]
    run(spark, docs, items)
    run(spark, docs, items, k=2, block_terms=1)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == []


def test_random_against_brute_force(spark):
    r = random.Random(7)
    words = [f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(3000)]
    docs = [(r.randint(0, 200), " ".join(r.choices(words, k=r.randint(0, 60)))) for _ in range(500)]
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 40)))) for i in range(60)] + [(100, "w1 w2 w3"), (101, "w1 w2 w3")]
    run(spark, docs, items, k=10)
    run(spark, docs, items, k=10, block_terms=150)
    run(spark, [(i, "w1 w2") for i in range(300)], items[-2:], k=20)  # all ties


def test_sharing_graph_is_exact_and_saves_sums():
    r = random.Random(2)
    for n_items, n_terms in ((1, 5), (30, 40), (80, 200)):
        items = [sorted(r.sample(range(n_terms), r.randint(0, min(30, n_terms)))) for _ in range(n_items)] + [[]]
        items += [items[0]] * 3
        g = share(items, n_terms)
        value = [r.randint(0, 10**6) for _ in range(n_terms)]
        node = [0] * g.size
        for t, v in enumerate(value):
            if any(t in x for x in items):
                node[g.home[t]] += v
        for i, (a, b) in enumerate(zip(g.left, g.right), g.base):
            assert max(a, b) < i
            node[i] = node[a] + node[b]
        assert [sum(node[x] for x in q) for q in g.nodes] == [sum(value[t] for t in x) for x in items]
        assert g.sums <= sum(max(0, len(x) - 1) for x in items)
    passage = list(range(30))
    g = share([passage + [30 + i] for i in range(20)], 60)
    assert g.sums <= 2 * 20 + 30  # the passage is added up once


def test_first_rows_of_a_hot_key(spark):
    df = spark.range(5000).select((F.col("id") % 10 == 0).alias("key"), (F.col("id") % 7).alias("v"), "id")
    got = first_rows(df, ["key"], [F.desc("v"), F.asc("id")], 3, ["id"])
    assert sorted((r.key, r["rank"], r.id) for r in got.collect()) == [(False, 1, 6), (False, 2, 13), (False, 3, 27), (True, 1, 20), (True, 2, 90), (True, 3, 160)]
