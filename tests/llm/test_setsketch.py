import random

import numpy as np

from helixspark.llm import neardup
from helixspark.llm.graph import components
from helixspark.llm.neardup import minima, shingle_sets
from helixspark.llm.setsketch import joint_similarity, merged, near_duplicates, registers


def brute(rows, k=4, t=80):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def family(seed):
    r = random.Random(seed)
    rows, at = [], 0
    for g in range(12):
        base = [f"w{r.randint(0, 4000)}" for _ in range(r.choice([30, 80, 200]))]
        for _ in range(r.choice([1, 2, 6, 60])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 30))):
                w[r.randrange(len(w))] = f"x{r.randint(0, 99)}"
            rows.append((at, " ".join(w)))
            at += 1
            base = w if g % 2 else base  # chains and stars
    rows += [(at, None), (at + 1, ""), (at + 2, "One two"), (at + 3, "one TWO"), (at + 4, "one two three"), (None, "one two three"),
             (None, None), (at + 4, "one two three"), (at + 5, " \n\t ")]
    r.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = family(seed)
        df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, key string")
        key = lambda r: tuple(-1 if x is None else x for x in r)
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=key)
        assert got == sorted(brute(rows), key=key)
    out = near_duplicates(df)
    assert out.where("kept != (doc_id <=> component_id)").count() == 0
    assert near_duplicates(df.limit(0)).count() == 0


def test_sketch_merges_and_estimates():
    r = np.random.default_rng(0)
    m = 4096
    for j in (0.3, 0.6, 0.9):
        common, own = int(3000 * j), int(3000 * (1 - j) / 2)
        x = r.integers(0, 2**63, common + 2 * own, dtype=np.uint64)
        a, b = x[:common + own], np.concatenate([x[:common], x[common + own:]])
        ra, rb, rab = (registers(minima([s], m)) for s in (a, b, x))
        assert (merged(ra, rb) == rab).all()
        est = joint_similarity(ra, rb, np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - common / len(x)) < 0.04


def test_words():
    def one(t, k=4):
        return shingle_sets([t], k)[0]

    assert len(one("A b\x0bC d")) == 1 and (one("A b\x0bC d") == one("a B c D")).all()
    assert len(one("a\xa0b c d")) == 1 and not (one("É b c d") == one("é b c d")).any()
    texts = ["", "a", "a b c d e", " \n", "a b c d e a b c d e", "x " * 5000, "é 語 x y z"]
    for k in (1, 4, 5):
        for t, s in zip(texts, shingle_sets(texts, k)):
            w = t.split()
            want = len({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else ()))
            assert len(s) == want and (s == one(t, k)).all()


def test_components(spark):
    r = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    more = [(100 + r.randint(0, 40), 100 + r.randint(0, 40)) for _ in range(30)]
    rows = [*chain, *more, (7, 7), (5, 4)]
    got = {x.node: x.root for x in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    root = {x: x for p in rows for x in p}
    for _ in range(100):
        for a, b in rows:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: y for x, y in root.items() if x != y}


def test_candidates_take_one_python_step_a_stage(spark, monkeypatch):
    plans, real = {}, neardup.written

    def kept(df, name, *a):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *a)

    monkeypatch.setattr(neardup, "written", kept)
    text = " ".join(f"w{i}" for i in range(60))
    near_duplicates(spark.createDataFrame([(1, text), (2, text + " tail")], "doc_id long, text string")).collect()
    # one cuts the texts, one sketches them behind the shuffle; workers of an executor follow their number
    assert plans["candidates"].count("MapInArrow") == 2
