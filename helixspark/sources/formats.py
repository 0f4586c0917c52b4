"""Readers and writers for the other text formats: FASTA, GTF, per-sample quant
tables, MatrixMarket triples and sample sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixspark.operators.common import prefix_sum
from helixspark.operators.expression import gtf_attributes
from helixspark.operators.genomic_order import natural_key
from helixspark.session import written_once


def read_fasta(spark: SparkSession, paths):
    """(records, rejects): one row per FASTA record (file_id, id, description, seq).

    Records are split by the text reader itself at a ``>`` that begins a line (``lineSep``), so
    a record never straddles two rows and large files split across tasks; wrapped
    sequence lines are joined and carriage returns dropped. An empty header becomes
    ``seqnum`` with its 0-based line in nine digits. Labels seen twice in a file go to
    ``rejects``.
    """
    raw = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", "true").text(paths)
    r = raw.select(F.col("_metadata.file_path").alias("file_id"), F.monotonically_increasing_id().alias("_at"),
                   F.col("value").alias("rec"))
    nameless = r.filter(F.col("rec").rlike(r"^>?\s*(\n|$)") & F.col("rec").rlike(r"\S"))
    r = r.withColumn("_line", F.lit(None).cast("long"))
    if not nameless.isEmpty():
        some = nameless.select("file_id").distinct()
        n = r.join(some, "file_id", "left_semi").withColumn("_k", F.regexp_count("rec", F.lit("\n")).cast("long") + 1)
        r = r.join(some, "file_id", "left_anti").unionByName(
            prefix_sum(n.drop("_line"), ["file_id"], ["_at"], "_k", "_line", inclusive=False).drop("_k"))
    r = r.withColumn("rec", F.regexp_replace("rec", "^>", "")).filter(F.col("rec").rlike(r"\S"))
    head = F.substring_index("rec", "\n", 1)
    body = F.expr("substring(rec, length(substring_index(rec, '\\n', 1)) + 2)")
    r = r.select("file_id", "_line", F.trim(F.regexp_replace(head, "\r", "")).alias("header"), F.regexp_replace(body, r"\s+", "").alias("seq"))
    r = r.withColumn("header", F.when(F.col("header") == "", F.format_string("seqnum%09d", "_line")).otherwise(F.col("header")))
    r = r.select("file_id", F.split_part("header", F.lit(" "), F.lit(1)).alias("id"),
                 F.trim(F.expr("substring(header, length(split_part(header, ' ', 1)) + 1)")).alias("description"), "seq")
    n = r.groupBy("file_id", "id").agg(F.count("*").alias("_n"))
    r = r.join(n, ["file_id", "id"])
    return r.filter(F.col("_n") == 1).drop("_n"), r.filter(F.col("_n") > 1).drop("_n")


GTF_COLUMNS = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attribute"]


def read_gtf(spark: SparkSession, paths) -> DataFrame:
    """GTF rows (comments skipped) with typed coordinates and an ``attrs`` map."""
    schema = ", ".join(f"{c} string" for c in GTF_COLUMNS)
    g = (spark.read.option("sep", "\t").option("comment", "#").option("quote", "").option("recursiveFileLookup", "true")
         .schema(schema).csv(paths))
    return g.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long")).withColumn(
        "attrs", gtf_attributes("attribute")).withColumn("file_id", F.col("_metadata.file_path"))


def read_quants(spark: SparkSession, paths, sample_from: str = "dir") -> DataFrame:
    """Many per-sample TSV tables (header line) -> one long table with ``sample``
    taken from the parent folder name (``dir``) or the file name (``file``)."""
    q = spark.read.option("sep", "\t").option("header", "true").option("inferSchema", "false").csv(paths)
    path = F.col("_metadata.file_path")
    if sample_from == "dir":  # a Hive-style ``key=value`` folder gives its value
        sample = F.regexp_replace(F.element_at(F.split(path, "/"), -2), "^[^=/]+=", "")
    else:
        sample = F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^([^.]+)", 1)
    return q.withColumn("sample", sample)


def numbered_lines(spark: SparkSession, paths, name: str = "idx") -> DataFrame:
    """(value, ``name``): the lines of text files with their 1-based position in file order.

    Spark reads the splits of a folder in an order of its own (largest first, several in one
    task), so positions come from the files themselves: files by name (numbers in names by value),
    splits by byte offset, lines by their place in the split. The lines are written once with
    their task's row number; per split the number of lines is counted, and a running sum over that
    table (one row a split) is joined back. Lines are neither shuffled by file nor held by one task.
    """
    raw = spark.read.text(paths).select("value", natural_key(F.col("_metadata.file_path")).alias("_file"),
                                        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    lines = written_once(raw, "lines")
    splits = lines.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(splits, ["_file", "_start"]).select("value", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name))


def write_mtx(triples: DataFrame, path: str, feature: str = "feature", cell: str = "cell", value: str = "n") -> None:
    """Triples -> MatrixMarket parts: ``matrix/`` (one file with the banner and the size line, many
    with ``feature_id cell_id value`` lines), ``features/`` and ``barcodes/`` (names in id
    order). Ids are ranks of the sorted names."""
    from helixspark.operators.expression import mtx_triples

    m, c, f = mtx_triples(triples, feature, cell, value)
    m.select(F.concat_ws(" ", "fid", "cid", F.col(value).cast("string")).alias("v")).write.mode("overwrite").text(
        f"{path}/matrix")
    f.orderBy("fid").select(feature).write.mode("overwrite").text(f"{path}/features")
    c.orderBy("cid").select(cell).write.mode("overwrite").text(f"{path}/barcodes")
    size = m.agg(F.max("fid"), F.max("cid"), F.count("*")).first()
    spark = triples.sparkSession
    spark.createDataFrame([("%%MatrixMarket matrix coordinate integer general",),
                           (f"{size[0] or 0} {size[1] or 0} {size[2]}",)], "v string").coalesce(1).write.mode(
        "append").text(f"{path}/matrix")


def mtx_entries(spark: SparkSession, matrix) -> DataFrame:
    """(row, col, value) of MatrixMarket coordinate lines. Comment (``%``) lines are skipped, and
    the size line: the first other line of each file that begins with a banner."""
    lines = spark.read.text(matrix).select(
        F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    banner = lines.filter(F.col("value").startswith("%%MatrixMarket")).select("file").distinct()
    lines = lines.filter(~F.col("value").startswith("%") & (F.col("value") != ""))
    size = lines.join(banner, "file", "left_semi").groupBy("file").agg(F.min_by("value", "at").alias("value"))
    # an entry may read like the size line: one line of that text goes, a second one is an entry
    alike = lines.join(size, ["file", "value"], "left_semi").groupBy("file", "value").agg(F.count("*").alias("n")).filter("n > 1")
    lines = lines.join(size, ["file", "value"], "left_anti").select("value").unionByName(alike.select("value"))
    parts = F.split(F.trim("value"), r"\s+")
    return lines.select(parts[0].cast("long").alias("row"), parts[1].cast("long").alias("col"),
                        F.get(parts, 2).cast("double").alias("value")).filter(F.col("value").isNotNull())


def mtx_axis(spark: SparkSession, paths, name: str, idx: str) -> DataFrame:
    """(``name``, ``idx``): the names of an axis file or folder (first tab field) with their line numbers."""
    return numbered_lines(spark, paths, idx).select(F.split("value", "\t")[0].alias(name), idx)


def read_mtx(spark: SparkSession, matrix, barcodes, features, transpose: bool = False) -> DataFrame:
    """MatrixMarket coordinate lines + axis files -> (feature, cell, value) triples.

    ``transpose``: the matrix is stored cells x features (some aligners write it
    that way). Axis ids are line numbers in file order, over all parts of an axis folder."""
    t = mtx_entries(spark, matrix)
    fi, ci = ("col", "row") if transpose else ("row", "col")
    f = mtx_axis(spark, features, "feature", "fid")
    c = mtx_axis(spark, barcodes, "cell", "cid")
    return t.join(f, t[fi] == f["fid"]).join(c, t[ci] == c["cid"]).select("feature", "cell", "value")


def read_sheet(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """Sample-sheet CSV with a header; a UTF-8 byte-order mark and surrounding
    quotes/spaces are removed from names and values; all columns stay strings."""
    r = spark.read.option("header", "true").option("encoding", "UTF-8").option("inferSchema", "false")
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    for c in df.columns:
        clean = c.replace("﻿", "").strip().strip('"')
        df = df.withColumnRenamed(c, clean)
    for c in df.columns:
        df = df.withColumn(c, F.trim(F.regexp_replace(F.col(c), '^"|"$', "")))
    return df
