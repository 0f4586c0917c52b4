"""Sample-sheet rules: duplicates, mixed read types, quotes and BOM."""

from helixspark.operators import validation as VL
from helixspark.operators.catalog import check_taxprofiler
from helixspark.sources.formats import read_sheet


def _sheet(spark, rows):
    return spark.createDataFrame(rows, "ord long, sample string, fastq_1 string, fastq_2 string, strandedness string")


def test_duplicate_row_rnaseq_rejects_scrnaseq_accepts(spark):
    rows = [(1, "A", "a_1.fastq.gz", "a_2.fastq.gz", "forward"), (2, "A", "a_1.fastq.gz", "a_2.fastq.gz", "forward")]
    ok, rej = VL.check_rnaseq(_sheet(spark, rows))
    assert [r["sample"] for r in ok.collect()] == ["A_T1"]
    assert [r["rule"] for r in rej.collect()] == ["duplicate_row"]
    ok2, rej2 = VL.check_scrnaseq(_sheet(spark, rows).drop("strandedness"))
    assert ok2.count() == 2 and rej2.count() == 0


def test_mixed_single_and_paired(spark):
    rows = [(1, "B", "b1_1.fastq.gz", "b1_2.fastq.gz", "reverse"), (2, "B", "b2_1.fq.gz", "", "reverse"),
            (3, "C", "c_1.fq.gz", "", "auto"), (4, "C", "c2_1.fq.gz", "", "auto")]
    ok, rej = VL.check_rnaseq(_sheet(spark, rows))
    assert sorted(r["sample"] for r in ok.collect()) == ["C_T1", "C_T2"]
    assert {r["rule"] for r in rej.collect()} == {"mixed_datatype"}


def test_bad_values(spark):
    rows = [(1, "", "x_1.fastq.gz", "x_2.fastq.gz", "forward"), (2, "D", "d.txt", "", "forward"), (3, "E", "e_1.fq.gz", "", "both")]
    _, rej = VL.check_rnaseq(_sheet(spark, rows))
    assert {r["ord"]: r["rule"] for r in rej.collect()} == {
        1: "sample_missing", 2: "fastq_extension", 3: "strandedness_invalid"}


def test_read_sheet_bom_quotes_and_header_order(spark, tmp_dir):
    p = f"{tmp_dir}/sheet.csv"
    with open(p, "w", encoding="utf-8") as f:
        f.write('﻿sample,run_accession,instrument_platform,fasta,fastq_1,fastq_2\n')
        f.write('"S1",ERR1,ILLUMINA,,"s1_1.fastq.gz",s1_2.fastq.gz\n')
        f.write('S2,ERR2,ILLUMINA,s2.fa.gz,,\n')
    s = read_sheet(spark, p)
    assert s.columns[0] == "sample"
    from pyspark.sql import functions as F

    ok, rej = check_taxprofiler(s.withColumn("ord", F.monotonically_increasing_id()))
    got = {r["sample"]: r["single_end"] for r in ok.collect()}
    assert got == {"S1": "0", "S2": "1"} and rej.count() == 0


def test_fastqc_pair_suffix(spark):
    rows = [(1, "F", "f_1.fastq.gz", "f_2.fq.gz", ""), (2, "G", "g_1.fq.gz", "g_2.fq.gz", "")]
    ok, rej = VL.check_fastqc(_sheet(spark, rows).drop("strandedness"))
    assert [r["rule"] for r in rej.collect()] == ["pair_extension"]
    assert [r["sample"] for r in ok.collect()] == ["G_T1"]


def test_second_single_cell_sheet(spark):
    cols = "ord long, sample string, fastq_1 string, fastq_2 string, expected_cells string, seq_center string"
    rows = [(1, "s 1", "a_1.fastq.gz", "a_2.fastq.gz", "100", "my centre"), (2, "s2", "b.fq.gz", "", "", ""), (3, "s3", "c.fq.gz", "", "x", ""),
            (4, "s 1", "a_1.fastq.gz", "a_2.fastq.gz", "100.0", ""), (5, "s5", "d.txt", "", "5", ""), (6, "", "d.fq.gz", "", "5", "c"), (7, "s7", "", "", "5", "")]
    ok, rej = VL.check_scrnaseq(spark.createDataFrame(rows, cols), extra_cols=True)
    assert sorted((r.ord, r.sample, r.expected_cells, r.seq_center, r.single_end) for r in ok.collect()) == [
        (1, "s_1", "100", "my_centre", "0"), (4, "s_1", "100.0", "", "0")]
    assert {r.ord: r.rule for r in rej.collect()} == {2: "expected_cells", 3: "expected_cells", 5: "fastq_extension", 6: "sample_missing", 7: "invalid_combination"}
    bare = spark.createDataFrame([r[:4] for r in rows[:1]], "ord long, sample string, fastq_1 string, fastq_2 string")
    assert [r.expected_cells for r in VL.check_scrnaseq(bare, extra_cols=True)[0].collect()] == [None]
    odd = bare.selectExpr("*", "'x' as lane")
    ok, rej = VL.check_scrnaseq(odd, extra_cols=True)
    assert ok.count() == 0 and [r.rule for r in rej.collect()] == ["unknown_column"]
    assert VL.check_scrnaseq(odd)[0].count() == 1
