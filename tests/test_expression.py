"""BED12 with codons, header trimming, added reference sequences, cell filters."""

import pytest

from helixspark.operators import expression as EX


def test_bed12_codons_and_order(spark):
    rows = [  # contig, tx, feature, start1, end1, strand, ord
        ("chr2", "b", "exon", 500, 600, "-", 1), ("chr2", "b", "exon", 100, 200, "-", 2),
        ("chr2", "b", "start_codon", 560, 562, "-", 3), ("chr2", "b", "stop_codon", 130, 132, "-", 4),
        ("chr1", "a", "exon", 11, 20, "+", 5), ("chr1", "a", "start_codon", 12, 14, "+", 6),
        ("chr1", "c", "miRNA", 5, 9, "+", 7), ("chr1", None, "exon", 1, 2, "+", 8), ("chr1", "", "exon", 1, 2, "+", 9),
        ("chr1", "d", "start_codon", 1, 3, "+", 10), ("chr1", "c", "gene", 1, 99, "+", 11),
        ("chr1", "a", "start_codon", 15, 17, "+", 12)]
    df = spark.createDataFrame(rows, "contig string, tx string, feature string, start1 long, end1 long, strand string, ord long")
    got = [tuple(r) for r in EX.to_bed12(df).collect()]
    assert got == [
        ("chr1", 4, 9, "c", 0, "+", 4, 9, 0, 1, "5,", "0,"),
        ("chr1", 10, 20, "a", 0, "+", 14, 20, 0, 1, "10,", "0,"),           # the last start codon counts
        ("chr2", 99, 600, "b", 0, "-", 129, 562, 0, 2, "101,101,", "0,400,")]  # swapped and widened by 2


def test_trim_and_append(spark):
    fa = spark.createDataFrame([("ENST1.2|ENSG1|x", "AC"), ("plain", "G"), ("", "T"), (None, "T")], "id string, seq string")
    assert [r.id for r in EX.trim_headers(fa).collect()] == ["ENST1.2", "plain", "", None]
    genome = spark.createDataFrame([("chr1", "ACGT")], "id string, seq string")
    extra = spark.createDataFrame([("gfp", "ACG")], "id string, seq string")
    gtf = EX.fasta_to_gtf(genome)
    both, rows = EX.append_reference(genome, extra, gtf, "gene_biotype")
    assert sorted(r.id for r in both.collect()) == ["chr1", "gfp"]
    added = [r for r in rows.collect() if r.seqname == "gfp"]
    assert rows.count() == 2 and added[0].end == 3 and 'gene_biotype "transgene"' in added[0].attribute
    assert EX.append_reference(genome, extra)[1] is None
    with pytest.raises(ValueError):
        EX.append_reference(genome, genome)


def test_cells_are_filtered_before_genes(spark):
    # c3 has one gene only and goes first; g2 is then seen in one cell less
    rows = [("g1", "c1", 1), ("g2", "c1", 1), ("g1", "c2", 1), ("g3", "c2", 2), ("g2", "c3", 5), ("g1", "c4", 0)]
    got = EX.filter_normalise(spark.createDataFrame(rows, "feature string, cell string, n long"), min_genes=2, min_cells=2)
    assert {(r.feature, r.cell, round(r.norm, 4)) for r in got.collect()} == {("g1", "c1", 9.2104), ("g1", "c2", 9.2104)}
