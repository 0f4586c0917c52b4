"""Centre assignment by block products and cluster profiles against brute force."""

import random
from collections import Counter, defaultdict

import pytest

from helixspark.operators import msa as M

SCHEMA = "chain int, msa_row long, seq string, deletions array<int>"


def _rows(n, seed, chains=2):
    rnd = random.Random(seed)
    return [(c, i, "".join(rnd.choice("ARN-DX") for _ in range(rnd.choice([12, 12, 9]))), [rnd.randint(0, 4) for _ in range(12)])
            for c in range(chains) for i in range(n)]


@pytest.mark.parametrize("gap", [0.0, 0.5])
def test_centres_and_profiles(spark, gap, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 16)
    rows = _rows(90, 1) + [(1, 500, "", []), (7, 3, "AR", [1, 1])]
    centre = lambda r: r[0] < 2 and r[1] % 9 == 0
    centers = spark.createDataFrame([r for r in rows if centre(r)], SCHEMA)
    extra = spark.createDataFrame([r for r in rows if not centre(r)], SCHEMA)
    got = M.assign_centers(extra, centers, gap)
    seen = {(r.chain, r.extra_row): (r.center_row, round(r.score, 6)) for r in got.collect()}
    want = {}
    for c, i, s, _ in rows:
        if c < 2 and not centre((c, i)):
            score = lambda t: sum((gap if a == "-" else 1.0) for a, b in zip(s, t) if a == b)
            best = min((-score(t), j) for d, j, t, _ in rows if d == c and centre((d, j)))
            want[c, i] = (best[1], round(-best[0], 6))
    assert seen == want  # chain 7 has no centres
    shares, dels = M.cluster_profiles(got, extra, centers, deletions="deletions")
    members = defaultdict(list)
    for c, i, s, d in rows:
        if centre((c, i)):
            members[c, i].append((s, d))
        elif c < 2:
            members[c, want[c, i][0]].append((s, d))
    w_share, w_del = {}, {}
    for (c, j), ms in members.items():
        for p in range(12):
            for x, n in Counter(s[p] for s, _ in ms if p < len(s)).items():
                w_share[c, j, p, x] = n / (1e-6 + len(ms))
            if any(p < len(s) for s, _ in ms):
                w_del[c, j, p] = sum(d[p] for s, d in ms if p < len(s)) / (1e-6 + len(ms))
    assert {(r.chain, r.center_row, r.pos, r.res): pytest.approx(r.share) for r in shares.collect()} == w_share
    assert {(r.chain, r.center_row, r.pos): pytest.approx(r.mean_deletions) for r in dels.collect()} == w_del


def test_hot_chain_is_spread(spark):
    rows = spark.createDataFrame([(0, i, "ARND" if i % 2 else "-RND", None) for i in range(3000)], SCHEMA)
    got = M.assign_centers(rows.filter("msa_row >= 1000"), rows.filter("msa_row < 1000"))
    assert got.groupBy("center_row").count().orderBy("center_row").collect() == [(0, 1000), (1, 1000)]


def test_scattered_centres_share_blocks(spark):
    """Few centres spread over a long alignment are one block, however far apart their rows are."""
    rows = spark.createDataFrame([(0, i * 1000, "ARND" if i % 2 else "-RND", None) for i in range(40)], SCHEMA)
    assert [len(r.c) for r in M._row_blocks(rows, "chain", "c").collect()] == [40]
