"""Writers that turn the fixture views into text files (VCF, FASTA, GTF, quant
tables, sample sheets), so the format readers run on files Spark derives from the
driver tables. Files go to a fresh folder under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.session import scratch_path

# Fixed header text of the exported VCFs.
VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Total depth">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP membership">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End position of a reference block">',
    '##FILTER=<ID=PASS,Description="All filters passed">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Read depth">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">',
    "##source=fixture-export",
]
CONTIG_LENGTH = 250_000_000


def fresh_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"exports/{name}-{uuid.uuid4().hex}")


def export_vcf(calls: DataFrame, path: str, more: tuple[str, ...] = ()) -> str:
    """f1-shaped calls -> one VCF per (sample, chromosome) under
    ``path/sampleid=<s>/chrom=<c>/``; every file carries its own header, with the lines of ``more``."""
    keys = calls.select("sampleid", "chrom").distinct()
    tmpl = F.array(*[F.lit(h) for h in (*VCF_HEADER, *more)])
    head = keys.select("sampleid", "chrom", F.posexplode(F.concat(
        tmpl,
        F.array(F.concat(F.lit("##contig=<ID="), F.col("chrom"), F.lit(f",length={CONTIG_LENGTH}>"))),
        F.array(F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.col("sampleid"))),
    )).alias("hidx", "value")).select("sampleid", "chrom", F.lit(0).alias("kind"), "hidx",
                                      F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("rec"), "value")
    body = calls.select("sampleid", "chrom", F.lit(1).alias("kind"), F.lit(0).alias("hidx"), "pos", "rec",
                        F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."),
                                    "filter", "info", "format", "sample").alias("value"))
    out = head.unionByName(body).repartition("sampleid", "chrom").sortWithinPartitions(
        "sampleid", "chrom", "kind", "hidx", "pos", "rec", "value")
    out.select("sampleid", "chrom", "value").write.mode("overwrite").partitionBy("sampleid", "chrom").text(path)
    return path


def export_fasta(msa: DataFrame, path: str, width: int = 20) -> str:
    """f7 rows -> FASTA files per chain; sequence lines wrapped at ``width``;
    ids repeat inside a file for every 97th row (``dup``) to exercise the check."""
    rid = F.when(F.col("row_no") % 97 == 0, F.lit("dup")).otherwise(F.concat(F.lit("seq"), F.col("row_no").cast("string")))
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})", "$1\n")
    rec = msa.select("chain", "row_no", F.concat(F.lit(">"), rid, F.lit(" "), F.col("species"), F.lit("\n"),
                                                  wrapped).alias("value"))
    rec.repartition("chain").sortWithinPartitions("chain", "row_no").select("chain", "value").write.mode(
        "overwrite").partitionBy("chain").text(path)
    return path


def export_gtf(exons: DataFrame, path: str) -> str:
    """f5 exons -> GTF files per contig with a comment line first."""
    attrs = F.format_string('gene_id "%s"; transcript_id "%s"; gene_biotype "%s";', F.col("gene_id"), F.col("tx"),
                            F.col("biotype"))
    line = F.concat_ws("\t", "contig", F.lit("fixture"), F.lit("exon"), F.col("start1").cast("string"),
                       F.col("end1").cast("string"), F.lit("."), "strand", F.lit("."), attrs)
    head = exons.select("contig").distinct().select("contig", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("s"),
                                                    F.lit("#!genome-build fixture").alias("value"))
    body = exons.select("contig", F.lit(1).alias("kind"), F.col("start1").cast("long").alias("s"), line.alias("value"))
    head.unionByName(body).repartition("contig").sortWithinPartitions("contig", "kind", "s", "value").select(
        "contig", "value").write.mode("overwrite").partitionBy("contig").text(path)
    return path


def export_quants(counts: DataFrame, path: str) -> str:
    """f3 counts -> one tab-separated quant table per sample folder."""
    q = counts.select("sample", F.col("tx").alias("Name"), F.lit(1000).alias("Length"),
                      F.col("n").cast("string").alias("NumReads"))
    q.repartition("sample").write.mode("overwrite").option("sep", "\t").option("header", "true").partitionBy(
        "sample").csv(path)
    return path


def export_sheet(sheet: DataFrame, path: str) -> str:
    """f11 sheet -> CSV with a header line (quoted when needed)."""
    sheet.write.mode("overwrite").option("header", "true").csv(path)
    return path
