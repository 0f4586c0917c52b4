"""Expression, taxonomy, catalog and format helpers; the driver contract."""

from pyspark.sql import functions as F

from helixspark.functions.sequence import a3m_deletions, species_id
from helixspark.operators import catalog as CA
from helixspark.operators import expression as EX
from helixspark.operators import taxonomy as TX
from helixspark.sources.formats import read_fasta


def test_bed12_minus_strand_with_codons(spark):
    ex = spark.createDataFrame([("chr1", "t1", 100, 199, "-"), ("chr1", "t1", 300, 399, "-")],
                               "contig string, tx string, start1 long, end1 long, strand string")
    cod = spark.createDataFrame([("t1", 380, 150)], "tx string, cds_start long, cds_end long")
    r = EX.to_bed12(ex, codons=cod).first()
    assert (r["chromStart"], r["chromEnd"], r["thickStart"], r["thickEnd"]) == (99, 399, 147, 382)
    assert r["blockSizes"] == "100,100," and r["blockStarts"] == "0,200,"


def test_species_and_a3m(spark):
    df = spark.createDataFrame([("tr|A0A146SKV9|A0A146SKV9_FUNHE/12-50 x", "abCDe-F")], "d string, s string")
    r = df.select(species_id("d").alias("sp"), a3m_deletions("s").alias("dl")).first()
    assert r["sp"] == "FUNHE" and r["dl"] == [2, 0, 1, 0]


def test_clean_lineage_and_docker_uri(spark):
    df = spark.createDataFrame([("d__Bacteria;p__Fir_mi;s__X_y",
                                 "\"${ workflow.containerEngine == 'singularity' ? 'https://a/b:1' : 'biocontainers/b:1' }\"")],
                               "l string, c string")
    r = df.select(TX.clean_lineage("l").alias("l"), CA.docker_uri("c").alias("u")).first()
    assert r["l"] == "Bacteria;Fir mi;X y" and r["u"] == "biocontainers/b:1"


def test_read_fasta_duplicates(spark, tmp_dir):
    p = f"{tmp_dir}/x.fa"
    with open(p, "w") as f:
        f.write(">a one\nACGT\nAC\n>b two\nGG\n>a again\nTT\n")
    ok, bad = read_fasta(spark, p)
    assert {r["id"]: r["seq"] for r in ok.collect()} == {"b": "GG"}
    assert bad.count() == 2


def test_entry_and_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["sampleid", "titv_ratio"] and df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 130
