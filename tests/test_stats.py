"""PCA by subspace iteration agrees with numpy's singular vectors; its parts multiply back."""

import numpy as np
import pytest

from helixspark.operators.expression import size_factors, top_variance
from helixspark.operators.stats import sample_pca, scale_pca


def _triples(X, row, col, value, zeros=False):
    return [(f"g{j:03d}", f"c{i:04d}", float(X[i, j])) for i in range(X.shape[0]) for j in range(X.shape[1]) if zeros or X[i, j] != 0]


def _svd(Z, k):
    U, S, Vt = np.linalg.svd(Z, full_matrices=False)
    return np.abs(U[:, :k] * S[:k]), np.abs(Vt[:k].T), S


@pytest.mark.parametrize("n_cells,n_genes,k", [(9, 3, 2), (60, 30, 3)])
def test_scale_pca_matches_numpy(spark, n_cells, n_genes, k):
    rng = np.random.default_rng(n_cells)
    X = rng.poisson(2.0, size=(n_cells, n_genes)).astype(float)
    X += np.outer(rng.integers(0, 3, n_cells) ** 2, np.arange(n_genes) % 3)  # some structure
    X[X.sum(1) == 0, 0] = 1.0
    norm = spark.createDataFrame(_triples(X, "cell", "feature", "norm"), "feature string, cell string, norm double")
    genes = spark.createDataFrame([(f"g{j:03d}",) for j in range(n_genes)], "feature string")
    scores, loadings, pct = scale_pca(norm, genes, k=k)
    sd = X.std(0, ddof=1)
    Z = ((X - X.mean(0)) / np.where(sd > 0, sd, 1))[:, sd > 0]
    U, V, S = _svd(Z, k)
    got = np.array([[r[f"PC{j + 1}"] for j in range(k)] for r in scores.orderBy("cell").collect()])
    assert np.allclose(np.abs(got), U, atol=1e-4)
    lo = np.array([[r[f"PC{j + 1}"] for j in range(k)] for r in loadings.orderBy("feature").collect()])
    assert np.allclose(np.abs(lo), V, atol=1e-4)
    assert np.allclose([r[1] for r in pct.orderBy("component").collect()], 100 * S[:k] ** 2 / (S ** 2).sum(), atol=1e-6)
    assert all(got[np.argmax(np.abs(got[:, j]).round(9)), j] > 0 for j in range(k))


def test_scale_pca_of_nothing(spark):
    norm = spark.createDataFrame([("g1", "c1", 1.0), ("g1", "c2", 1.0)], "feature string, cell string, norm double")
    for genes in ([], [("g1",)], [("absent",)]):  # no gene has variance
        scores, loadings, pct = scale_pca(norm, spark.createDataFrame(genes, "feature string"), k=2)
        assert sorted(tuple(r) for r in scores.collect()) == [("c1", None, None), ("c2", None, None)]
        assert loadings.count() == 0 and [r[1] for r in pct.collect()] == [0.0, 0.0]


def test_sample_pca_matches_numpy_with_absent_genes(spark):
    rng = np.random.default_rng(1)
    X = rng.poisson(1.2, size=(7, 40)) * rng.uniform(1, 2, size=(7, 40))
    df = spark.createDataFrame(_triples(X, "sample", "gene_id", "v"), "gene_id string, sample string, v double")
    scores, _, pct = sample_pca(df, n_top=25, k=3)
    top = sorted(range(40), key=lambda j: (-round(X[:, j].var(ddof=1), 12), j))[:25]
    C = (X - X.mean(0))[:, top]
    U, _, S = _svd(C, 3)
    got = np.array([[r["PC1"], r["PC2"], r["PC3"]] for r in scores.orderBy("sample").collect()])
    assert np.allclose(np.abs(got), U, atol=1e-6)
    assert np.allclose([r[1] for r in pct.orderBy("component").collect()], 100 * S[:3] ** 2 / (S ** 2).sum(), atol=1e-8)


def test_top_variance_counts_absent_as_zero(spark):
    df = spark.createDataFrame([("g1", "a", 4.0), ("g1", "b", 4.0), ("g2", "a", 3.0), ("g3", "b", 1.0)], "gene_id string, sample string, v double")
    got = {r.gene_id: r.variance for r in top_variance(df, 5).collect()}
    assert got == {"g1": 0.0, "g2": 4.5, "g3": 0.5}


def test_size_factors_against_plain_median(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{j}", f"s{i}", int(x)) for i in range(4) for j, x in enumerate(rng.poisson(30 * (i + 1), 301))]
    df = spark.createDataFrame(rows, "gene_id string, sample string, n long")
    x = np.array([r[2] for r in rows], float).reshape(4, 301)
    ok = (x > 0).all(0)
    want = np.exp(np.median(np.log(x[:, ok]) - np.log(x[:, ok]).mean(0), axis=1))
    got = [r.size_factor for r in size_factors(df).orderBy("sample").collect()]
    assert np.allclose(got, want, atol=1e-12)


def test_dup_rate_fit_works_out_the_rates_once(spark, monkeypatch):
    from helixspark.plans import q_stats as Q

    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "gene_id string, all_reads long, dup_rate double, rpk double"
    rates = spark.createDataFrame([(f"g{i}", 10 + i, (i % 7 + 1) / 10, 1.5 * i) for i in range(1, 40)], schema).mapInArrow(run, schema)
    monkeypatch.setattr(Q, "pairs_of", lambda *a: rates)
    monkeypatch.setattr(Q, "fixture", lambda *a: rates)
    monkeypatch.setattr(Q.AL, "mark_duplicates", lambda df: df)
    monkeypatch.setattr(Q.AL, "dup_rates", lambda df, exons: df)
    got = {r["equation"]: (r["residual"], r["genes"]) for r in Q.q_dup_rate_fit(spark, "").collect()}
    assert got == {"intercept": (0.0, 39), "slope": (0.0, 39)}
    assert seen.value == 39
