"""VCF / gVCF text -> record DataFrames and header tables.

``spark.read.text`` splits plain files across tasks; ``.gz`` files are read whole
by one task each (gzip is not splittable), so the records are repartitioned on
(chrom, pos) range afterwards when ``repartition`` is given. The source path of
every line comes from the hidden ``_metadata.file_path`` column, which ties
records to their file's ``#CHROM`` sample list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.session import written_once
from helixspark.sources.bgzf import read_bgzf_lines


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """All lines of the VCF files with their file path (sub folders included).

    Spark's text reader knows ``.gz`` but not the block-gzip ending ``.bgz``; those files are cut
    into splits and unpacked member by member (``sources.bgzf``)."""
    df = spark.read.option("recursiveFileLookup", "true").text(paths)
    text = df.select(F.col("_metadata.file_path").alias("file_id"), F.col("value").alias("line")).filter(
        ~F.col("file_id").endswith(".bgz"))
    packed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.bgz").load(paths)
    if packed.select("path").isEmpty():
        return text
    return text.unionByName(read_bgzf_lines(spark, paths))


def _from(arr, first: int):
    """The array from its ``first`` element (1-based) to its end."""
    return F.slice(arr, F.lit(first), F.greatest(F.size(arr) - (first - 1), F.lit(0)))


def read_vcf(spark: SparkSession, paths, repartition: int | None = None, lines: DataFrame | None = None):
    """(records, rejects).

    records: file_id, chrom, pos, vcf_id, ref, alt, qual, filter, info, format,
    sample_names, sample_values (raw text values, as the layouts expect).
    rejects: data lines with fewer than 8 fields (file_id, line, reason).
    """
    ln = lines if lines is not None else read_lines(spark, paths)
    data = ln.filter(~F.col("line").startswith("#") & (F.length(F.trim("line")) > 0))
    f = data.select("file_id", "line", F.split(F.regexp_replace("line", r"[\r\n]+$", ""), "\t").alias("f"))
    good = f.filter(F.size("f") >= 8)
    rejects = f.filter(F.size("f") < 8).select("file_id", "line", F.lit("fewer than 8 fields").alias("reason"))
    # one header row per file, written: its size is known, so while it is small no record is shuffled
    hdr = written_once(ln.filter(F.col("line").startswith("#CHROM")).select(
        "file_id", _from(F.split(F.regexp_replace("line", r"[\r\n]+$", ""), "\t"), 10).alias("sample_names")), "vcf-samples")
    rec = good.select(
        "file_id",
        F.col("f")[0].alias("chrom"),
        F.col("f")[1].try_cast("long").alias("pos"),
        F.col("f")[2].alias("vcf_id"),
        F.col("f")[3].alias("ref"),
        F.col("f")[4].alias("alt"),
        F.col("f")[5].alias("qual"),
        F.col("f")[6].alias("filter"),
        F.col("f")[7].alias("info"),
        F.get(F.col("f"), 8).alias("format"),
        _from(F.col("f"), 10).alias("sample_values"),
    )
    rec = rec.join(hdr, "file_id", "left").withColumn(
        "sample_names", F.coalesce("sample_names", F.array().cast("array<string>")))
    if repartition:
        rec = rec.repartitionByRange(repartition, "chrom", "pos")
    return rec, rejects


def _kv(line, key: str):
    """Value of ``key=`` inside a ``##X=<...>`` header line (quoted or bare)."""
    return F.regexp_extract(line, f'[<,]{key}=("[^"]*"|[^,>]*)', 1)


def _unquote(c):
    return F.regexp_replace(c, r'^"|"$', "")


def vcf_header(lines: DataFrame):
    """(samples, info_fields, format_fields) of each file from its header lines."""
    h = lines.filter(F.col("line").startswith("#"))
    samples = h.filter(F.col("line").startswith("#CHROM")).select(
        "file_id", F.posexplode(_from(F.split(F.regexp_replace("line", r"[\r\n]+$", ""), "\t"), 10)).alias("position", "sample_name"))

    def defs(prefix: str):
        d = h.filter(F.col("line").startswith(prefix))
        return d.select("file_id", _kv("line", "ID").alias("id"), _kv("line", "Number").alias("number"),
                        _kv("line", "Type").alias("type"), _unquote(_kv("line", "Description")).alias("description"))

    return samples, defs("##INFO=<"), defs("##FORMAT=<")


def header_tables(lines: DataFrame) -> dict[str, DataFrame]:
    """The seven header tables, keyed by ``file_id = md5(path)``: vcf_files,
    contigs, filters, info_fields, format_fields, samples, header_metadata."""
    h = lines.filter(F.col("line").startswith("#")).withColumn("file_key", F.md5("file_id"))
    samples, info, fmt = vcf_header(lines)
    key = lambda df: df.withColumn("file_key", F.md5("file_id"))
    files = h.groupBy("file_key", "file_id").agg(
        F.max(F.when(F.col("line").startswith("##fileformat="), F.substring_index("line", "=", -1))).alias("fileformat"),
        F.count("*").alias("header_lines"))
    contigs = h.filter(F.col("line").startswith("##contig=<")).select(
        "file_key", _kv("line", "ID").alias("contig"), _kv("line", "length").try_cast("long").alias("length"))
    filters = h.filter(F.col("line").startswith("##FILTER=<")).select(
        "file_key", _kv("line", "ID").alias("filter"), _unquote(_kv("line", "Description")).alias("description"))
    structured = F.col("line").rlike("^##(INFO|FORMAT|FILTER|contig)=<") | F.col("line").startswith("##fileformat=")
    meta = h.filter(F.col("line").startswith("##") & ~structured).select(
        "file_key", F.regexp_extract("line", "^##([^=]+)=", 1).alias("key"),
        F.regexp_extract("line", "^##[^=]+=(.*)$", 1).alias("value"))
    return {
        "vcf_files": files,
        "contigs": contigs,
        "filters": filters,
        "info_fields": key(info).drop("file_id"),
        "format_fields": key(fmt).drop("file_id"),
        "samples": key(samples).drop("file_id"),
        "header_metadata": meta,
    }
