"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixspark.llm.common import written


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b`` of one type) but the roots
    themselves; the root is the smallest node of the component.

    Each step hangs a node's larger neighbours (large star) or smaller ones (small star) on the
    smallest of them, which needs a number of rounds about the square of the logarithm of the
    longest path; every round's edges are a written table, at most one row per edge. Loops,
    null ends, repeated and turned edges are allowed.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.union(low).distinct(), "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
