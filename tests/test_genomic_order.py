"""Coordinate order as a sink: contig dictionaries, files in order, regions open their files only."""

import random

from helixspark.operators.genomic_order import numbered_rows, read_region, region_files, sort_genomic, write_sorted

SCHEMA = "chrom string, pos long, id long"


def _rows(n=4000):
    rnd = random.Random(4)
    return [(rnd.choice(["chr2", "chr10", "chr1", "chr1", "chr1", "chrX", "scaf7"]), rnd.randint(1, 500), i) for i in range(n)]


def _key(chrom, numbers):
    return (numbers.get(chrom, 10**9), "" if chrom in numbers else "".join(x.rjust(20, "0") if x.isdigit() else x for x in
            "".join(c if c.isdigit() else f" {c} " for c in chrom).split()))


def test_natural_order_without_a_dictionary(spark):
    df = spark.createDataFrame([(c, 1, i) for i, c in enumerate(["chr10", "chrX", "chr2", "chr1", "chr2"])], SCHEMA)
    assert [r.chrom for r in sort_genomic(df, ties=("id",)).collect()] == ["chr1", "chr2", "chr2", "chr10", "chrX"]


def test_files_and_regions(spark, tmp_dir):
    rows, numbers = _rows(), {"chrX": 1, "chr10": 2, "chr1": 3}
    contigs = spark.createDataFrame(list(numbers.items()) + [("chr1", 9)], "contig string, number int")
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    write_sorted(df, tmp_dir, contigs, ties=("id",), files=12)
    want = sorted(rows, key=lambda r: (_key(r[0], numbers), r[1], r[2]))
    assert [r.id for r in sort_genomic(df, contigs, ties=("id",)).collect()] == [r[2] for r in want]
    got = {r.ord: (r.chrom, r.pos, r.id) for r in numbered_rows(spark, tmp_dir).collect()}
    assert got == dict(enumerate(want, 1))
    for chrom, a, b in (("chr1", 100, 110), ("chr2", 1, 500), ("scaf7", 499, 900), ("chr1", 600, 700), ("none", 1, 9)):
        hit = read_region(spark, tmp_dir, chrom, a, b)
        assert {r.id for r in hit.collect()} == {r[2] for r in rows if r[0] == chrom and a <= r[1] <= b}
        assert len(hit.inputFiles()) == len(region_files(spark, tmp_dir, chrom, a, b))
    assert len(region_files(spark, tmp_dir, "chr1", 100, 110)) <= 2


def test_empty(spark, tmp_dir):
    write_sorted(spark.createDataFrame([], SCHEMA), tmp_dir)
    assert numbered_rows(spark, tmp_dir).count() == 0 and read_region(spark, tmp_dir, "chr1", 1, 5).count() == 0
