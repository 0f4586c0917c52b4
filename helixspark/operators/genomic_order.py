"""Coordinate order as a sink: globally sorted files, their borders, and region reads that open
only the files that a region meets.

Contigs are ordered by a dictionary (contig, number), as a sequence dictionary lists them; contigs
that it lacks come last, in natural order (``chr2`` before ``chr10``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Number of contigs that the dictionary lacks: behind all others.
UNLISTED = 2**31 - 1


def natural_key(c: str | Column) -> Column:
    """Text whose plain order is natural order: runs of digits are padded."""
    runs = F.regexp_extract_all(c, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 20, "0")).otherwise(x)), "")


def _keyed(df: DataFrame, contigs: DataFrame | None, chrom: str) -> DataFrame:
    """``df`` with ``contig_no`` and ``contig_key``, the two parts of the contig order."""
    if contigs is None:
        df = df.withColumn("contig_no", F.lit(UNLISTED))
    else:
        first = contigs.groupBy(F.col("contig").alias("_contig")).agg(F.min("number").cast("int").alias("contig_no"))
        df = df.join(first, F.col(chrom) == F.col("_contig"), "left").drop("_contig").withColumn("contig_no", F.coalesce("contig_no", F.lit(UNLISTED)))
    return df.withColumn("contig_key", F.when(F.col("contig_no") == UNLISTED, natural_key(chrom)).otherwise(""))


def sort_genomic(df: DataFrame, contigs: DataFrame | None = None, chrom: str = "chrom", pos: str = "pos", ties: tuple[str, ...] = ()) -> DataFrame:
    """``df`` in contig order, then by position and ``ties``: one range shuffle."""
    return _keyed(df, contigs, chrom).orderBy("contig_no", "contig_key", pos, *ties).drop("contig_no", "contig_key")


def write_sorted(df: DataFrame, path: str, contigs: DataFrame | None = None, chrom: str = "chrom", pos: str = "pos",
                 ties: tuple[str, ...] = (), files: int | None = None) -> None:
    """Globally sorted Parquet files under ``path/rows`` and their borders under ``path/borders``.

    Rows are range-partitioned by (contig, position, ties), so a contig that holds most rows is
    spread over many files; file names follow the order. The border table has a row per file: its
    place, rows, rows before it, and the first and last position per contig are a row each.
    """
    order = ["contig_no", "contig_key", pos, *ties]
    keyed = _keyed(df, contigs, chrom)
    parts = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    parts.sortWithinPartitions(*order).withColumn("file_no", F.spark_partition_id()).write.mode("overwrite").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    spans = rows.groupBy("file_no", chrom).agg(F.min(pos).alias("first_pos"), F.max(pos).alias("last_pos"), F.count("*").alias("n"),
                                               F.first(F.col("_metadata.file_path")).alias("file"))
    total = spans.groupBy("file_no").agg(F.sum("n").alias("file_rows"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    total = total.withColumn("rows_before", F.coalesce(F.sum("file_rows").over(before), F.lit(0)))
    spans.join(total, "file_no").coalesce(1).write.mode("overwrite").parquet(f"{path}/borders")


def numbered_rows(spark: SparkSession, path: str, name: str = "ord") -> DataFrame:
    """The sorted rows with their 1-based place: rows of earlier files plus the row's place in its
    file, both known without a shuffle of the rows."""
    rows = spark.read.parquet(f"{path}/rows").select("*", (F.col("_metadata.row_index") + 1).alias("_at"))
    before = spark.read.parquet(f"{path}/borders").select("file_no", "rows_before").distinct()
    return rows.join(before, "file_no").withColumn(name, F.col("rows_before") + F.col("_at")).drop(
        "file_no", "rows_before", "_at", "contig_no", "contig_key")


def region_files(spark: SparkSession, path: str, chrom: str, start: int, end: int, chrom_col: str = "chrom") -> list[str]:
    """Files that hold rows of the region: their names alone come to the driver."""
    b = spark.read.parquet(f"{path}/borders")
    hit = b.filter((F.col(chrom_col) == chrom) & (F.col("first_pos") <= end) & (F.col("last_pos") >= start))
    return sorted(r["file"] for r in hit.select("file").collect())


def read_region(spark: SparkSession, path: str, chrom: str, start: int, end: int, chrom_col: str = "chrom", pos: str = "pos") -> DataFrame:
    """Rows of ``chrom:start-end`` (closed) from the files that the borders name."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = region_files(spark, path, chrom, start, end, chrom_col)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter((F.col(chrom_col) == chrom) & F.col(pos).between(start, end)).drop("file_no", "contig_no", "contig_key")
