"""MinHash near-duplicates with SetSketch registers.

A register holds the exponent of the smallest exponential variate of a set, counted in
powers of ``b`` and cut to the range 0 .. q + 1. Registers of a union are the maxima of the
registers, and equal registers are as likely as sets are similar, so bands of registers
serve as buckets. Two sketches are compared by the likelihood of their register order, which
uses both set sizes; full shingle sets then confirm every link.

Cases: null text or one without words has an empty set and is linked with nothing; copies are
one class; repeated rows of an id give repeated rows of the same result (other text under a
used id is another document of that id); a null id is never the smallest id of a component
unless all are null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import map_batches, table, texts_of, written
from helixspark.llm.neardup import Banding, first_texts, near_classes, signatures

BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2


def registers(minima: np.ndarray) -> np.ndarray:
    """SetSketch registers of uniform 64-bit minima (a minimum of variates is the variate of
    the minimum)."""
    u = (minima.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-np.minimum(u, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def _step(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def joint_similarity(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 40) -> np.ndarray:
    """Most likely Jaccard similarity given how many registers of one sketch are above, below
    and equal to the other's; the likelihood is concave, so its top is bracketed."""
    ra, rb = ra.astype(np.int32), rb.astype(np.int32)
    up, down = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)

    def fit(j):
        pu, pd = _step(u - v * j), _step(v - u * j)
        tiny = 1e-300
        return up * np.log(pu + tiny) + down * np.log(pd + tiny) + same * np.log(np.maximum(1 - pu - pd, 0) + tiny)

    for _ in range(steps):
        x, y = hi - (hi - lo) * 0.618033988749895, lo + (hi - lo) * 0.618033988749895
        left = fit(x) > fit(y)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2


def sketch_banding(k: int = 4, threshold: int = 80) -> Banding:
    """21 bands of 3 registers: at similarity 0.8 a link is missed with probability 3e-7."""
    return Banding(k, 3, 21, registers, joint_similarity, "<u2", threshold)


def near_duplicates(df: DataFrame, k: int = 4, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_shingles``, ``component_id`` and ``kept``."""
    p = sketch_banding(k, threshold)
    kind = df.schema[id_col].dataType.simpleString()
    d = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(c):
        n, key, bands = signatures(texts_of(c["text"]), p)
        return {"id": c["id"], "n": n, "key": key, "bands": bands}

    sig = written(map_batches(d, run, f"id {kind}, n long, key long, bands array<long>"), "sketches")
    some = sig.where("n > 0")
    first = some.groupBy("key").agg(F.min("id").alias("first"))
    comp = near_classes(some.select("key", "bands"), partial(first_texts, d, k), p)
    placed = first.join(comp.withColumnRenamed("node", "key"), "key", "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    home = placed.join(least, "root").select("key", "component_id")
    out = sig.select("id", "n", "key").join(home, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op2_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
