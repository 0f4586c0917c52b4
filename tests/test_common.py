"""Scalable rank / prefix-sum / neighbour helpers and binned range joins agree with
plain window functions and brute force, for 1 and 16 input partitions."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helixspark.operators.common import exact_median, neighbours, prefix_sum, rank_within
from helixspark.operators.rangejoin import _standing, interval_join, overlap_join


@pytest.fixture()
def skewed(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", rnd.randint(0, 50), i, rnd.randint(1, 5)) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, o int, id int, v int")


@pytest.mark.parametrize("parts", [1, 16])
def test_rank_prefix_neighbours(spark, skewed, parts):
    df = skewed.repartition(parts)
    w = Window.partitionBy("k").orderBy("o", "id")
    ref = df.withColumn("rk", F.row_number().over(w)).withColumn(
        "cum", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "prev_v", F.lag("v").over(w)).withColumn("next_v", F.lead("v").over(w))
    a = rank_within(df, ["k"], ["o", "id"], "rk").select("id", "rk")
    b = prefix_sum(df, ["k"], ["o", "id"], "v", "cum").select("id", "cum")
    c = neighbours(df, ["k"], ["o", "id"], ["v"]).select("id", "prev_v", "next_v")
    got = a.join(b, "id").join(c, "id")
    exp = {r["id"]: (r["rk"], r["cum"], r["prev_v"], r["next_v"]) for r in ref.collect()}
    assert {r["id"]: (r["rk"], r["cum"], r["prev_v"], r["next_v"]) for r in got.collect()} == exp


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_helpers_over_many_partitions(spark, coalesce):
    """200,000 rows with a payload and null keys, kept in many shuffle partitions."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
            (F.xxhash64("id") % 1000).alias("o"), "id", (F.col("id") % 9).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        w = Window.partitionBy("k").orderBy("o", "id")
        want = df.select("id", F.row_number().over(w).alias("rk"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                         F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
        a = rank_within(df, ["k"], ["o", "id"], "rk").select("id", "rk", "payload")
        b = prefix_sum(df, ["k"], ["o", "id"], "v", "cum").select("id", "cum")
        c = neighbours(df, ["k"], ["o", "id"], ["v"]).select("id", F.col("prev_v").alias("p"), F.col("next_v").alias("n"))
        got = a.where("payload = sha2(cast(id as string), 256)").join(b, "id").join(c, "id").select("id", "rk", "cum", "p", "n")
        assert got.count() == 200_000
        assert got.exceptAll(want.select(got.columns)).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_interval_and_overlap_joins_match_brute_force(spark):
    rnd = random.Random(2)
    pts = [(i, "c1", rnd.randint(0, 5000)) for i in range(400)]
    ivs = [(j, "c1", s, s + rnd.randint(0, 300)) for j, s in enumerate(rnd.randint(0, 5000) for _ in range(200))]
    p = spark.createDataFrame(pts, "pid int, chrom string, pos long")
    iv = spark.createDataFrame(ivs, "iid int, chrom string, s long, e long")
    got = {(r["pid"], r["iid"]) for r in interval_join(p, iv, "chrom", "pos", "pos", "s", "e", bin_size=64).collect()}
    exp = {(a, b) for a, _, x in pts for b, _, s, e in ivs if s <= x <= e}
    assert got == exp
    left = iv.select(F.col("iid").alias("lid"), "chrom", F.col("s").alias("ls"), F.col("e").alias("le"))
    got2 = {(r["lid"], r["iid"]) for r in overlap_join(left, iv, "chrom", "ls", "le", "s", "e", bin_size=50).collect()}
    exp2 = {(a, b) for a, _, s1, e1 in ivs for b, _, s2, e2 in ivs if s1 <= e2 and s2 <= e1}
    assert got2 == exp2


def test_levelled_bins_keep_rows_few(spark):
    """A block of 10 Gb and a point interval meet in a handful of rows, at any length."""
    rnd = random.Random(5)
    spans = [(j, "c1", s, s + rnd.choice([0, 1, 60, 5000, 2**20, 10**10])) for j, s in enumerate(rnd.randint(0, 10**10) for _ in range(80))]
    pts = [(i, "c1", rnd.randint(0, 2 * 10**10)) for i in range(150)] + [(999, "c2", 5), (1000, None, 7)]
    iv = spark.createDataFrame(spans, "iid int, chrom string, s long, e long")
    p = spark.createDataFrame(pts, "pid int, chrom string, pos long")
    assert _standing(iv, "s", "e", 128).count() <= 2 * len(spans)
    got = {(r["pid"], r["iid"]) for r in interval_join(p, iv, "chrom", "pos", "pos", "s", "e", bin_size=128).collect()}
    assert got == {(a, j) for a, c, x in pts for j, d, s, e in spans if c == d and s <= x <= e}
    left = spark.createDataFrame([(i + 1000, c, s + 7, e + 7) for i, c, s, e in spans] + [(5000, "c1", 9, 3)], "lid int, chrom string, ls long, le long")
    rows = overlap_join(left, iv, "chrom", "ls", "le", "s", "e", bin_size=128).collect()
    want = {(i + 1000, j) for i, _, a, b in spans for j, _, s, e in spans if a + 7 <= e and s <= b + 7}
    assert {(r["lid"], r["iid"]) for r in rows} == want and len(rows) == len(want)


def test_exact_median(spark):
    rnd = random.Random(9)
    rows = [(k, v) for k in ("hot", "b", None, "one") for v in
            ([rnd.choice([0.5, 1e-300, 3.0, rnd.random(), -rnd.random() * 1e9]) for _ in range({"hot": 4001, "b": 10, "one": 1}.get(k, 7))])]
    rows += [("same", 2.0)] * 50 + [("next", 1.0), ("next", 1.0 + 2**-52), ("next", 1.0 + 2**-51), ("empty", None)]
    got = {r.k: r["median"] for r in exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    want = {k: statistics.median([v for x, v in rows if x == k]) for k in {r[0] for r in rows} - {"empty"}}
    assert got == want
