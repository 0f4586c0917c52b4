import numpy as np

from helixspark.llm.embeddings import forest, link_vectors, linked


def brute(rows, t=0.93):
    ok = [v is not None and lab is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v, lab in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= t:
                    links[i] += 1
                    links[j] += 1
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least[find(i)]) for i in range(n)]


def test_against_all_pairs(spark):
    r = np.random.default_rng(3)
    rows, at = [], 0
    for g in range(60):
        base = r.normal(size=16)
        for _ in range(int(r.choice([1, 1, 2, 5, 30]))):
            rows.append((at, [float(x) for x in (base + r.normal(size=16) * 0.14).astype(np.float32)], int(r.integers(0, 3)) if g % 3 else 1))
            at += 1
    rows += [(at, rows[0][1], rows[0][2]), (at + 1, rows[0][1], None), (at + 2, None, 1), (at + 3, [], 1), (at + 4, [0.0] * 16, 1),
             (at + 5, [float("nan")] * 16, 1), (at + 6, [float("inf")] + [0.0] * 15, 1), (at + 7, [None] + [1.0] * 15, 1), (at + 8, [1.0, 2.0], 1), (at + 9, [2.0, 4.0], 1)]
    rows += [(5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*x, b"clash", 1) for x in rows], "vec_id long, embedding array<float>, label int, key binary, n_links int").repartition(4)
    for options in ({}, {"block": 7, "lent_block": 5}):
        out = link_vectors(df, **options).collect()
        assert sorted((x.vec_id, x.n_links, x.component_id) for x in out) == sorted(brute(rows))
    assert all(x.kept == (x.vec_id == x.component_id) for x in out)
    assert link_vectors(df.limit(0)).count() == 0


def test_default_reach_on_the_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(x.vec_id, x.embedding, x.label) for x in df.collect()]
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in link_vectors(df).collect()) == sorted(brute(rows))


def test_forest():
    m = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (1, 2)):
        m[a, b] = m[b, a] = True
    assert sorted(forest(m)) == [(2, 1), (3, 0), (5, 0)]
    assert sorted(forest(m[:3, 2:], True)) == [(4, 0), (3, 1)] or sorted(forest(m[:3, 2:], True)) == [(3, 1), (4, 0)]


def test_borderline_cosines_as_doubles_tell():
    r = np.random.default_rng(6)
    a, d = r.normal(size=(400, 64)), r.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    d -= a * (a * d).sum(1, keepdims=True)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    c = 0.93 + r.choice([-1e-9, 1e-9, -1e-6, 1e-6, 0.01], 400)
    b = a * c[:, None] + d * np.sqrt(1 - c * c)[:, None]
    assert (linked(a, b, 0.93) == (a @ b.T >= 0.93)).all()


def test_default_reach_on_uneven_spectra(spark):
    """Partners at cosine 0.931, components falling off as 1/i: the query's own defaults."""
    r = np.random.default_rng(4)
    scale = 1 / np.arange(1, 65)
    rows = []
    for i in range(1500):
        a, d = r.normal(size=64) * scale, r.normal(size=64) * scale
        a /= np.linalg.norm(a)
        d -= a * (a @ d)
        for v in (a, 0.931 * a + (1 - 0.931 ** 2) ** 0.5 * d / np.linalg.norm(d)):
            rows.append((len(rows), v.tolist(), 1))
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.93).sum(1) - 1
    out = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)).collect()
    assert {o.vec_id: o.n_links for o in out} == dict(enumerate(links.tolist()))
