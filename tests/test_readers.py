"""Readers on literal files: endings, borders, empty names, size lines, deep trees."""

import gzip
import os
import zlib

import pytest
from pyspark.sql import functions as F

from helixspark.operators.expression import sample_distance
from helixspark.operators.structure import entity_label
from helixspark.operators.taxonomy import ancestors, clade_counts, merge_runs
from helixspark.sources.formats import numbered_lines, read_fasta, read_mtx, write_mtx
from helixspark.sources.vcf import read_lines, read_vcf, vcf_header

VCF = ("##fileformat=VCFv4.2\n##INFO=<ID=DP,Number=1,Type=Integer,Description=\"d\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
       "chr1\t5\t.\tA\tC\t.\tPASS\tDP=3\tGT\t0/1\t1/1\r\n")


def test_vcf_endings(spark, tmp_dir):
    open(f"{tmp_dir}/a.vcf", "w", newline="").write(VCF)
    gzip.open(f"{tmp_dir}/b.vcf.gz", "wt", newline="").write(VCF)
    with open(f"{tmp_dir}/c.vcf.bgz", "wb") as f:  # several gzip members, one cut inside a line
        for part in (VCF[:70], VCF[70:200], VCF[200:]):
            f.write(gzip.compress(part.encode()))
    rec, rej = read_vcf(spark, tmp_dir)
    got = {os.path.basename(r.file_id): (r.pos, r.sample_names, r.sample_values) for r in rec.collect()}
    assert got == {n: (5, ["s1", "s2"], ["0/1", "1/1"]) for n in ("a.vcf", "b.vcf.gz", "c.vcf.bgz")}
    assert rej.count() == 0
    assert vcf_header(read_lines(spark, tmp_dir))[0].count() == 6


def test_fasta_borders(spark, tmp_dir):
    open(f"{tmp_dir}/x.fa", "w", newline="").write(">s1 A->B mutant\r\nAC\r\nGT\r\n>\r\nTT\r\n>s2\r\nGG>C\r\n>\r\nA\r\n")
    ok, bad = read_fasta(spark, tmp_dir)
    assert {(r.id, r.description, r.seq) for r in ok.collect()} == {
        ("s1", "A->B mutant", "ACGT"), ("seqnum000000003", "", "TT"), ("s2", "", "GG>C"), ("seqnum000000007", "", "A")}
    assert bad.count() == 0


def test_mtx_size_line(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/m")
    open(f"{tmp_dir}/m/matrix.mtx", "w").write("%%MatrixMarket matrix coordinate integer general\n% note\n2 2 3\n1 1 5\n2 1 7\n2 2 3\n")
    open(f"{tmp_dir}/f.tsv", "w").write("g1\ng2\n")
    open(f"{tmp_dir}/c.tsv", "w").write("c1\nc2\n")
    got = read_mtx(spark, f"{tmp_dir}/m", f"{tmp_dir}/c.tsv", f"{tmp_dir}/f.tsv").collect()
    assert sorted(map(tuple, got)) == [("g1", "c1", 5.0), ("g2", "c1", 7.0), ("g2", "c2", 3.0)]
    t = spark.createDataFrame([("g1", "c1", 2), ("g2", "c2", 2)], "feature string, cell string, n long")
    write_mtx(t, f"{tmp_dir}/w")  # its size line "2 2 2" reads like its second entry
    back = read_mtx(spark, f"{tmp_dir}/w/matrix", f"{tmp_dir}/w/barcodes", f"{tmp_dir}/w/features")
    assert sorted(map(tuple, back.collect())) == [("g1", "c1", 2.0), ("g2", "c2", 2.0)]


def test_multi_part_axis_files(spark, tmp_dir):
    """Ordered parts of unequal size, cut into many splits, keep the order of the files."""
    names = [f"gene{i:05d}" for i in range(30_000)]
    os.makedirs(f"{tmp_dir}/f")
    cuts = [0, 5, 20_000, 20_001, 30_000]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        open(f"{tmp_dir}/f/part-{[2, 9, 10, 101][k]}.tsv", "w").write("".join(f"{x}\tsymbol\n" for x in names[a:b]))
    open(f"{tmp_dir}/c.tsv", "w").write("c1\nc2\n")
    open(f"{tmp_dir}/m.mtx", "w").write("%%MatrixMarket matrix coordinate integer general\n30000 2 5\n" + "".join(
        f"{i} {1 + i % 2} {i}\n" for i in (1, 5, 6, 20_001, 30_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = read_mtx(spark, f"{tmp_dir}/m.mtx", f"{tmp_dir}/c.tsv", f"{tmp_dir}/f").collect()
        assert sorted(map(tuple, got)) == sorted((names[i - 1], f"c{1 + i % 2}", float(i)) for i in (1, 5, 6, 20_001, 30_000))
        lines = numbered_lines(spark, f"{tmp_dir}/f").collect()
        assert {r.idx: r.value.split("\t")[0] for r in lines} == dict(enumerate(names, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    t = spark.createDataFrame([(n, f"c{i % 3}", i + 1) for i, n in enumerate(names)], "feature string, cell string, n long")
    write_mtx(t, f"{tmp_dir}/w")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([x for x in os.listdir(f"{tmp_dir}/w/features") if x.startswith("part")]) > 1
    back = read_mtx(spark, f"{tmp_dir}/w/matrix", f"{tmp_dir}/w/barcodes", f"{tmp_dir}/w/features")
    assert back.join(t, ["feature", "cell"]).filter("value = n").count() == len(names) == back.count()


def _bgzf(data, size, level=6):
    out = b""
    for i in range(0, len(data), size):
        c = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = c.compress(data[i:i + size]) + c.flush()
        head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little")
        out += head + body + zlib.crc32(data[i:i + size]).to_bytes(4, "little") + len(data[i:i + size]).to_bytes(4, "little")
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


@pytest.mark.parametrize("split", ["1k", "128m"])
def test_block_gzip_in_parallel(spark, tmp_dir, split):
    """Members over many splits, lines over many members, a member that holds the separator."""
    text = "##é header\n" + "".join(f"chr1\t{i}\t{'x' * (i * 37 % 300)} ü\n" for i in range(2000)) + "long " + "y" * 5000 + "\n\nno end"
    data = text.encode() + b" \x1f\x8b\x08\x04 \x1f\x8b\x08\x04\n last"
    open(f"{tmp_dir}/a.vcf.bgz", "wb").write(_bgzf(data, 700))
    open(f"{tmp_dir}/b.vcf.bgz", "wb").write(_bgzf(data, 900, level=0))  # stored: the separator stands in the data
    open(f"{tmp_dir}/c.vcf.bgz", "wb").write(gzip.compress(data))
    open(f"{tmp_dir}/d.vcf.bgz", "wb").write(_bgzf(b"", 10))
    want = sorted(x.decode("utf-8", "replace") for x in data.split(b"\n") if x)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_lines(spark, tmp_dir).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by = {n: sorted(r.line for r in got if r.file_id.endswith(n) and r.line) for n in ("a.vcf.bgz", "b.vcf.bgz", "c.vcf.bgz", "d.vcf.bgz")}
    assert by["a.vcf.bgz"] == by["b.vcf.bgz"] == by["c.vcf.bgz"] == want and by["d.vcf.bgz"] == []


def test_clade_counts_of_a_long_chain(spark):
    """100,000 nodes below each other: 17 rounds of one row a node, no closure."""
    n = 100_000
    tax = spark.range(n).select("id", F.greatest(F.col("id") - 1, F.lit(0)).alias("parent"))
    counts = spark.createDataFrame([("s", n - 1, 5), ("s", 70_000, 2), ("s", 0, 1), ("s", 70_000, 1), ("t", 10, 4), ("s", n + 7, 9)], "sample string, taxon long, n long")
    r = clade_counts(counts, tax)
    got = {(x.sample, x.taxon): (x.clade_reads, x.taxon_reads) for x in r.filter("taxon in (0, 10, 11, 70000, 70001, 99999)").collect()}
    assert got == {("s", 0): (9, 1), ("s", 10): (8, 0), ("s", 11): (8, 0), ("s", 70_000): (8, 3), ("s", 70_001): (5, 0), ("s", n - 1): (5, 5),
                   ("t", 0): (4, 0), ("t", 10): (4, 4)}
    assert r.count() == n + 11
    with pytest.raises(ValueError):
        clade_counts(counts, spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4)], "id long, parent long"))


def test_deep_taxonomy_and_cycle(spark):
    tax = spark.createDataFrame([(i, max(i - 1, 0)) for i in range(80)], "id long, parent long")
    assert ancestors(tax).filter("id = 79").count() == 80
    with pytest.raises(ValueError):
        ancestors(spark.createDataFrame([(1, 2), (2, 1)], "id long, parent long"))


def test_entity_labels(spark):
    def name(n):
        out = ""
        while n:
            n, d = divmod(n - 1, 26)
            out += chr(65 + d)
        return out

    numbers = [1, 26, 27, 28, 702, 703, 18278, 18279, 475255, 2**40]
    got = spark.createDataFrame([(n,) for n in numbers], "n long").select(entity_label("n").alias("l")).collect()
    assert [r.l for r in got] == [name(n) for n in numbers]


def test_null_metadata_and_absent_genes(spark):
    runs = spark.createDataFrame([("a", None, "r1", "f1", None), ("a", None, "r2", "f2", None)], "sample string, kind string, run_accession string, fastq_1 string, fastq_2 string")
    assert [(r.n_runs, r.concatenate) for r in merge_runs(runs, ["sample", "kind"]).collect()] == [(2, True)] * 2
    counts = spark.createDataFrame([("g1", "x", 4.0), ("g2", "y", 3.0), ("g3", "z", 1.0)], "gene_id string, sample string, v double")
    d = {(r.s1, r.s2): r.distance for r in sample_distance(counts).select("s1", "s2", F.round("distance", 6).alias("distance")).collect()}
    assert d["x", "y"] == 5.0 and d["x", "x"] == 0.0 and d["y", "z"] == round(10 ** 0.5, 6)
