"""Range joins over levelled bins (point in interval, interval overlap).

Spark has no interval-join strategy, and a plain non-equi join on (key, start <= pos <= end)
becomes a nested loop. Bins of level L are ``bin_size * 2**L`` long. An interval stands only at the
level of its own length, where it touches two bins at most, however long it is; who looks for
intervals asks once per level that occurs (at most 63, the number of doublings of a coordinate). So
the rows of both sides grow with the tables and not with the lengths, and the join is an equi-join
on (key, level, bin) with the exact residual predicate. A crowded bin is a skewed key that AQE's
skew join splits.

``bin_size`` is the length of the shortest bins: near the shortest common interval length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level(start: Column, end: Column, size: int) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2((end - start + 1) / F.lit(float(size))))).cast("int")


def _bin(pos: Column, level: Column, size: int) -> Column:
    return F.floor(pos / (F.lit(size) * F.pow(F.lit(2.0), level))).cast("long")


def _standing(df: DataFrame, start: str, end: str, size: int) -> DataFrame:
    """A row per bin of the interval's own level: one or two. Empty intervals have none."""
    df = df.filter(F.col(start) <= F.col(end)).withColumn("_level", _level(F.col(start), F.col(end), size))
    return df.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_level"), size), _bin(F.col(end), F.col("_level"), size))))


def _levels(df: DataFrame, start: str, end: str, size: int) -> list[int]:
    """Levels that occur: 63 numbers at most."""
    found = df.filter(F.col(start) <= F.col(end)).select(_level(F.col(start), F.col(end), size).alias("l")).distinct().collect()
    return sorted(r["l"] for r in found)


def _asking(df: DataFrame, start: Column, end: Column, size: int, levels: list[int], above: int | None) -> DataFrame:
    """A row per bin that ``start..end`` touches at each of ``levels`` that lies ``above`` levels
    or more over the interval's own (None: points, all levels)."""
    at = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
    if above is not None:
        own = _level(start, end, size)
        at = F.filter(at, lambda x: x >= own + above)
    df = df.withColumn("_level", F.explode(at))
    return df.withColumn("_bin", F.explode(F.sequence(_bin(start, F.col("_level"), size), _bin(end, F.col("_level"), size))))


def interval_join(points: DataFrame, intervals: DataFrame, key: str, point_col: str, out_pos: str,
                  start: str, end: str, bin_size: int = 10_000) -> DataFrame:
    """Rows of ``points`` joined to every interval of ``intervals`` with ``start <= point <= end`` on
    the same ``key`` (closed interval)."""
    i = _standing(intervals.withColumnRenamed(key, "_ikey"), start, end, bin_size)
    p = _asking(points, F.col(point_col), F.col(point_col), bin_size, _levels(intervals, start, end, bin_size), None)
    cond = ((p[key] == i["_ikey"]) & (p["_level"] == i["_level"]) & (p["_bin"] == i["_bin"])
            & (p[point_col] >= i[start]) & (p[point_col] <= i[end]))
    return p.join(i, cond).drop("_bin", "_level", "_ikey")


def overlap_join(left: DataFrame, right: DataFrame, key: str, l_start: str, l_end: str,
                 r_start: str, r_end: str, bin_size: int = 10_000) -> DataFrame:
    """Pairs of intervals on the same ``key`` that overlap (closed ends), each pair once.

    The shorter interval of a pair asks at the level of the longer one: left intervals ask at the
    right levels that are not below their own, right ones at the left levels above their own. Of
    the bins that a pair shares the first one counts.
    """
    right = right.withColumnRenamed(key, "_rkey")
    l0, l1, r0, r1 = (F.col(c) for c in (l_start, l_end, r_start, r_end))
    rows = (l0 <= l1, r0 <= r1)
    left, right = left.filter(rows[0]), right.filter(rows[1])
    cond = (F.col(key) == F.col("_rkey")) & (F.col("l._level") == F.col("r._level")) & (F.col("l._bin") == F.col("r._bin"))
    cond = cond & (l0 <= r1) & (r0 <= l1) & (F.col("l._bin") == _bin(F.greatest(l0, r0), F.col("l._level"), bin_size))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.alias("l").join(b.alias("r"), cond).drop("_bin", "_level", "_rkey")

    up = met(_asking(left, l0, l1, bin_size, _levels(right, r_start, r_end, bin_size), 0), _standing(right, r_start, r_end, bin_size))
    down = met(_standing(left, l_start, l_end, bin_size), _asking(right, r0, r1, bin_size, _levels(left, l_start, l_end, bin_size), 1))
    return up.unionByName(down)
