"""Registered scan / sink queries: fixture views are written as text files by Spark
and read back with the format readers (round trips checked against the views)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.plans import exports as X
from helixspark.plans.fixtures import fixture, with_views
from helixspark.plans.registry import register
from helixspark.sources import formats as FM
from helixspark.sources import vcf as VS


def _vcf_lines(spark, sf):
    path = X.export_vcf(fixture(spark, sf, "f1_calls"), X.fresh_dir(spark, "vcf"))
    return VS.read_lines(spark, path)


@register("vcf_scan", with_views("""
select sampleid as sample_name, chrom, pos, '.' as vcf_id, ref, alt, '.' as qual, filter, info, format, sample as sample_value
from f1_calls""", "f1_calls"))
def q_vcf_scan(spark, sf):
    rec, _ = VS.read_vcf(spark, None, lines=_vcf_lines(spark, sf))
    return rec.select(F.get(F.col("sample_names"), 0).alias("sample_name"), "chrom", "pos", "vcf_id", "ref", "alt",
                      "qual", "filter", "info", "format", F.get(F.col("sample_values"), 0).alias("sample_value"))


@register("vcf_header_scan", with_views("""
, files as (select distinct sampleid, chrom from f1_calls),
defs as (select * from (values ('DP', '1', 'Integer'), ('DB', '0', 'Flag'), ('END', '1', 'Integer')) v(id, number, type))
select f.sampleid as sample_name, f.chrom, d.id, d.number, d.type from files f, defs d""", "f1_calls"))
def q_vcf_header(spark, sf):
    lines = _vcf_lines(spark, sf)
    samples, info, _ = VS.vcf_header(lines)
    j = info.join(samples, "file_id")
    return j.select("sample_name", F.regexp_extract("file_id", r"chrom=([^/]+)/", 1).alias("chrom"), "id", "number",
                    "type")


@register("header_tables", with_views("""
select distinct sampleid as sample_name, chrom as contig, cast(250000000 as bigint) as length, 3 as n_info, 3 as n_format,
  1 as n_filters, 'VCFv4.2' as fileformat, 1 as n_metadata from f1_calls""", "f1_calls"))
def q_header_tables(spark, sf):
    t = VS.header_tables(_vcf_lines(spark, sf))
    per = lambda name, alias: t[name].groupBy("file_key").agg(F.count("*").cast("int").alias(alias))
    out = (t["samples"].select("file_key", "sample_name").join(t["contigs"], "file_key")
           .join(per("info_fields", "n_info"), "file_key").join(per("format_fields", "n_format"), "file_key")
           .join(per("filters", "n_filters"), "file_key").join(per("header_metadata", "n_metadata"), "file_key")
           .join(t["vcf_files"].select("file_key", "fileformat"), "file_key"))
    return out.select("sample_name", "contig", "length", "n_info", "n_format", "n_filters", "fileformat", "n_metadata")


@register("fasta_scan", with_views("""
, r as (select chain, case when row_no % 97 = 0 then 'dup' else concat('seq', cast(row_no as varchar)) end as id, species, seq from f7_msa),
n as (select chain, id, count(*) as k from r group by 1, 2)
select r.chain, r.id, r.species as description, r.seq, n.k = 1 as ok from r join n on n.chain = r.chain and n.id = r.id""",
                                    "f7_msa"))
def q_fasta_scan(spark, sf):
    path = X.export_fasta(fixture(spark, sf, "f7_msa"), X.fresh_dir(spark, "fasta"))
    ok, bad = FM.read_fasta(spark, path)
    chain = F.regexp_extract("file_id", r"chain=([0-9]+)/", 1).cast("long").alias("chain")
    cols = [chain, "id", "description", "seq"]
    return ok.select(*cols, F.lit(True).alias("ok")).unionByName(bad.select(*cols, F.lit(False).alias("ok")))


@register("gtf_scan", with_views("""
select contig as seqname, 'exon' as feature, start1 as start, end1 as "end", strand, gene_id, tx as transcript_id, biotype
from f5_exons""", "f5_exons"))
def q_gtf_scan(spark, sf):
    path = X.export_gtf(fixture(spark, sf, "f5_exons"), X.fresh_dir(spark, "gtf"))
    g = FM.read_gtf(spark, path)
    a = F.col("attrs")
    return g.select("seqname", "feature", "start", "end", "strand", a["gene_id"].alias("gene_id"),
                    a["transcript_id"].alias("transcript_id"), a["gene_biotype"].alias("biotype"))


@register("quant_scan", with_views("""
select sample, tx as Name, cast(n as varchar) as NumReads from f3_counts""", "f3_counts"))
def q_quant_scan(spark, sf):
    path = X.export_quants(fixture(spark, sf, "f3_counts"), X.fresh_dir(spark, "quant"))
    return FM.read_quants(spark, path).select("sample", "Name", "NumReads")


@register("mtx_write", with_views("""
select tx as feature, dense_rank() over (order by tx) as fid, sample as cell, dense_rank() over (order by sample) as cid,
  cast(n as bigint) as n from f3_counts""", "f3_counts"))
def q_mtx_write(spark, sf):
    t = fixture(spark, sf, "f3_counts").select(F.col("tx").alias("feature"), F.col("sample").alias("cell"), "n")
    path = X.fresh_dir(spark, "mtx")
    FM.write_mtx(t, path)
    m = FM.mtx_entries(spark, f"{path}/matrix").select(F.col("row").alias("fid"), F.col("col").alias("cid"), F.col("value").cast("long").alias("n"))
    f = FM.mtx_axis(spark, f"{path}/features", "feature", "fid")
    return m.join(f, "fid").join(FM.mtx_axis(spark, f"{path}/barcodes", "cell", "cid"), "cid").select("feature", "fid", "cell", "cid", "n")


@register("mtx_scan", with_views("""
select tx as feature, sample as cell, cast(n as double) as value from f3_counts""", "f3_counts"))
def q_mtx_scan(spark, sf):
    t = fixture(spark, sf, "f3_counts").select(F.col("tx").alias("feature"), F.col("sample").alias("cell"), "n")
    path = X.fresh_dir(spark, "mtx")
    FM.write_mtx(t, path)
    return FM.read_mtx(spark, f"{path}/matrix", f"{path}/barcodes", f"{path}/features")


@register("sheet_scan", with_views("""
select cast(ord as varchar) as ord, sample, fastq_1, fastq_2, strandedness from f11_sheet""",
                                    "f11_sheet"))
def q_sheet_scan(spark, sf):
    path = X.export_sheet(fixture(spark, sf, "f11_sheet"), X.fresh_dir(spark, "sheet"))
    s = FM.read_sheet(spark, path)
    return s.select("ord", F.coalesce("sample", F.lit("")).alias("sample"), "fastq_1",
                    F.coalesce("fastq_2", F.lit("")).alias("fastq_2"), "strandedness")
