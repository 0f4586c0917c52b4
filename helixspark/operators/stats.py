"""Statistics at scale: PCA of samples and of cells by distributed subspace iteration, and the
duplication-rate binomial fit (MLlib GLM)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixspark.operators.expression import top_variance
from helixspark.session import written_once

#: Columns that a subspace has beyond the components asked for: they speed up convergence.
SPARE = 8


def _block(b: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1) if names else np.zeros((b.num_rows, 0))


def _gram(df: DataFrame, names: list[str]) -> np.ndarray:
    """The inner products of the named double columns. Each task multiplies its rows in numpy and
    sends one small matrix; the matrices are summed by place, and only the sum is collected."""
    n = len(names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((n, n))
        for b in batches:
            x = _block(b, names)
            g += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * n), pa.int32()), pa.array(g.ravel(), pa.float64())], names=["at", "v"])

    out = np.zeros(n * n)
    for r in df.select(*names).mapInArrow(partial, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(n, n)


def _cols(name: str, p: int) -> list[str]:
    return [f"{name}{j}" for j in range(p)]


def _turned(df: DataFrame, key: str, name: str, turn: np.ndarray) -> DataFrame:
    """Columns ``name``0.. times a small matrix, beside the key."""
    n, m = turn.shape
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _block(b, _cols(name, n)) @ turn
            yield pa.RecordBatch.from_arrays([b.column(key), *[pa.array(x[:, j]) for j in range(m)]], names=[key, *_cols(name, m)])

    return df.select(key, *_cols(name, n)).mapInArrow(run, ", ".join([f"`{key}` {kind}", *[f"{c} double" for c in _cols(name, m)]]))


class Matrix:
    """A sparse matrix with rows (``row``, ``col``, ``w``) from which ``shift`` of each column is
    taken away without ever being written out: entry = w - shift, also where no row is stored.

    ``rows`` lists the row names, ``cols`` (``col``, ``shift``) the columns. Products with a narrow
    block of vectors (columns ``y0, y1, ...``) are two joins and two grouped sums over the stored
    entries.
    """

    def __init__(self, entries: DataFrame, rows: DataFrame, cols: DataFrame):
        self.entries = written_once(entries, "pca-entries")
        self.rows = written_once(rows, "pca-rows")
        self.cols = written_once(cols, "pca-cols")
        self.n_rows, self.n_cols = self.rows.count(), self.cols.count()

    def down(self, y: DataFrame, total: np.ndarray) -> DataFrame:
        """(col, shift, v0..): the transposed matrix times ``y`` (row, y0..) with column sums ``total``."""
        p = len(total)
        got = self.entries.join(y, "row").groupBy("col").agg(*[F.sum(F.col("w") * F.col(f"y{j}")).alias(f"_{j}") for j in range(p)])
        return self.cols.join(got, "col", "left").select("col", "shift", *[
            (F.coalesce(f"_{j}", F.lit(0.0)) - F.col("shift") * F.lit(float(total[j]))).alias(f"v{j}") for j in range(p)])

    def up(self, v: DataFrame, shifted: np.ndarray) -> DataFrame:
        """(row, one, y0..): the matrix times ``v`` (col, v0..), whose products with the shifts are given."""
        p = len(shifted)
        got = self.entries.join(v, "col").groupBy("row").agg(*[F.sum(F.col("w") * F.col(f"v{j}")).alias(f"_{j}") for j in range(p)])
        return self.rows.join(got, "row", "left").select("row", F.lit(1.0).alias("one"), *[
            (F.coalesce(f"_{j}", F.lit(0.0)) - F.lit(float(shifted[j]))).alias(f"y{j}") for j in range(p)])


def _whitening(g: np.ndarray) -> np.ndarray:
    """A matrix that turns columns with inner products ``g`` into orthonormal ones; columns that
    depend on others go."""
    size = np.sqrt(np.clip(np.diag(g), 0, None))
    keep = size > 0
    if not keep.any():
        return np.zeros((len(g), 0))
    w, u = np.linalg.eigh(g[np.ix_(keep, keep)] / np.outer(size[keep], size[keep]))
    good = w > 1e-13 * w.max()
    turn = np.zeros((len(g), int(good.sum())))
    turn[keep] = u[:, good] / np.sqrt(w[good]) / size[keep][:, None]
    return turn


def _orthonormal(y: DataFrame, p: int) -> tuple[DataFrame, np.ndarray]:
    """An orthonormal base of the columns y0.. of a written table (row, one, y0..) and its column
    sums. Turned twice, as the first turn loses digits where columns are nearly alike."""
    g = _gram(y, ["one", *_cols("y", p)])
    turn = _whitening(g[1:, 1:])
    if turn.shape[1]:
        turn = turn @ _whitening(_gram(_turned(y, "row", "y", turn), _cols("y", turn.shape[1])))
    return _turned(y, "row", "y", turn), g[0, 1:] @ turn


def principal_components(m: Matrix, k: int, max_rounds: int = 60, tol: float = 1e-10):
    """(scores, loadings, variances) of the ``k`` largest components of a ``Matrix``.

    A block of ``k + SPARE`` vectors is multiplied by the matrix and its transpose and made
    orthonormal again, round by round, until the ``k`` variances are steady; each round is two
    joins and grouped sums over the stored entries, and only p x p products of the narrow blocks
    reach the driver (p = k + SPARE), whatever the numbers of rows and columns. The start is drawn
    from hashes of the row names, so runs repeat. ``scores``: (row, y0..) = U * s, ``loadings``:
    (col, v0..) unit vectors; both have one column a component, as many as the matrix has. The
    largest score of a component by size (ties: smallest row) is positive.
    """
    p = min(k + SPARE, m.n_rows)
    empty = (m.rows.select("row"), m.cols.select("col"), np.zeros(0))
    if not p or not m.n_cols:
        return empty
    seed = lambda j: F.xxhash64(F.lit(j), F.col("row").cast("string")) / F.lit(2.0 ** 63)
    y, total = _orthonormal(m.rows.select("row", F.lit(1.0).alias("one"), *[seed(j).alias(f"y{j}") for j in range(p)]), p)
    last = None
    for _ in range(max_rounds):
        p = len(total)
        if not p:
            return empty
        v = written_once(m.down(y, total), "pca-down")
        g = _gram(v, ["shift", *_cols("v", p)])
        w, q = np.linalg.eigh(g[1:, 1:])
        w, q = w[::-1][:k], q[:, ::-1][:, :k]
        if p == m.n_rows or (last is not None and len(last) == len(w) and np.all(np.abs(w - last) <= tol * max(w.max(), 1e-300))):
            break
        last = w
        y, total = _orthonormal(written_once(m.up(v.drop("shift"), g[0, 1:]), "pca-up"), p)
    ok = w > 1e-12 * max(w.max(), 1e-300)
    w, q = w[ok], q[:, ok]
    if not len(w):
        return empty
    scores = written_once(_turned(y, "row", "y", q * np.sqrt(w)), "pca-scores")
    peak = scores.agg(*[F.min_by(F.col(c), F.struct(-F.round(F.abs(F.col(c)), 9), "row")) for c in _cols("y", len(w))]).first()
    sign = np.diag([-1.0 if x < 0 else 1.0 for x in peak])
    return _turned(scores, "row", "y", sign), _turned(v, "col", "v", q / np.sqrt(w) @ sign), w


def _named(df: DataFrame, key: str, to: str, name: str, have: int, k: int) -> DataFrame:
    return df.select(F.col(key).alias(to), *[(F.col(f"{name}{j}") if j < have else F.lit(None).cast("double")).alias(f"PC{j + 1}") for j in range(k)])


def _percent(spark, variances: np.ndarray, total: float, k: int) -> DataFrame:
    pct = [(f"PC{j + 1}", float(100 * variances[j] / total) if j < len(variances) and total > 0 else 0.0) for j in range(k)]
    return spark.createDataFrame(pct, "component string, percent_variance double")


def sample_pca(log_counts: DataFrame, n_top: int = 500, k: int = 2, feature: str = "gene_id",
               sample: str = "sample", value: str = "v"):
    """Centred PCA of samples on the ``n_top`` most variable genes: (scores, loadings, percent_variance).

    A gene that a sample lacks is 0 there and counts in the gene's mean. ``percent_variance`` is the
    share in all variance of the chosen genes. Components beyond the rank are null.
    """
    spark = log_counts.sparkSession
    x = log_counts.groupBy(F.col(feature).alias("col"), F.col(sample).alias("row")).agg(F.sum(F.col(value).cast("double")).alias("w"))
    rows = x.select("row").distinct()
    top = top_variance(log_counts, n_top, feature, value, sample).select(F.col(feature).alias("col"))
    x = x.join(top, "col", "left_semi")
    n = float(rows.count())
    cols = x.groupBy("col").agg((F.sum("w") / n).alias("shift"), F.sum(F.col("w") * F.col("w")).alias("_q"))
    m = Matrix(x, rows, cols.select("col", "shift"))
    scores, loadings, var = principal_components(m, k)
    total = cols.agg(F.sum(F.col("_q") - n * F.col("shift") * F.col("shift"))).first()[0] or 0.0
    return (_named(scores, "row", sample, "y", len(var), k), _named(loadings, "col", feature, "v", len(var), k),
            _percent(spark, var, total, k))


def scale_pca(norm: DataFrame, genes: DataFrame, k: int = 10, feature: str = "feature", cell: str = "cell", value: str = "norm"):
    """Per-cell PCA on z-scaled genes: (scores, loadings, percent_variance).

    Means and deviations include the cells where a gene is 0; genes without variance go. Values
    stay sparse: each is divided by its gene's deviation, and mean / deviation is the shift that the
    products take away, so neither a dense matrix nor a cell x cell or gene x gene one is made. Each
    cell and each gene of the input is a row, components beyond the rank are null.
    """
    spark = norm.sparkSession
    g = genes.select(F.col(feature).alias("col")).distinct()
    rows = norm.select(F.col(cell).alias("row")).distinct()
    n = float(rows.count())
    x = norm.select(F.col(feature).alias("col"), F.col(cell).alias("row"), F.col(value).cast("double").alias("x")).join(g, "col", "left_semi")
    mom = x.groupBy("col").agg(F.sum("x").alias("_s1"), F.sum(F.col("x") * F.col("x")).alias("_s2"))
    mom = mom.withColumn("_mu", F.col("_s1") / F.lit(n)).withColumn("_var", (F.col("_s2") - n * F.col("_mu") * F.col("_mu")) / F.lit(max(n - 1, 1.0)))
    mom = written_once(mom.filter(F.col("_var") > 1e-12 * F.col("_s2") / F.lit(max(n, 1.0))).select("col", "_mu", F.sqrt("_var").alias("_sd")), "pca-moments")
    m = Matrix(x.join(mom, "col").select("row", "col", (F.col("x") / F.col("_sd")).alias("w")), rows,
               mom.select("col", (F.col("_mu") / F.col("_sd")).alias("shift")))
    scores, loadings, var = principal_components(m, k)
    return (_named(scores, "row", cell, "y", len(var), k), _named(loadings, "col", feature, "v", len(var), k),
            _percent(spark, var, m.n_cols * (n - 1), k))


def fit_dup_rate(rates: DataFrame):
    """Binomial GLM (logit) of the duplication rate on log10(reads per kb),
    weighted by the gene's read count; returns (intercept, slope)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    d = rates.filter((F.col("rpk") > 0) & F.col("dup_rate").isNotNull()).withColumn("lx", F.log10("rpk"))
    d = VectorAssembler(inputCols=["lx"], outputCol="features").transform(d)
    glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="dup_rate", weightCol="all_reads",
                                      featuresCol="features", maxIter=50)
    m = glm.fit(d)
    return float(m.intercept), float(m.coefficients[0])
