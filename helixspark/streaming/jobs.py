"""Structured Streaming jobs.

* ``append_stream``: VCF files dropped into a folder are loaded into a layout in
  micro-batches (``foreachBatch``). Every batch writes its tables under ``batch_id=<n>``
  with overwrite and then one commit marker, so a batch replayed after a failure rewrites
  the same folder and readers see all tables of a batch or none.
* ``status_stream``: run-status events -> tumbling-window counts per status
  (event time, watermark, so its state is bounded) and the latest status per run. Both are
  kept as compacted tables (``upsert_batch``): reading one takes a snapshot and the few batches
  since, however many batches there have been.

Checkpoints live in the given folder (the shared checkpoint folder on a cluster).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.operators import variants as VA
from helixspark.session import written_once
from helixspark.sources.vcf import read_vcf

LAYOUTS = {1: VA.to_layout1, 2: VA.to_layout2, 3: VA.to_layout3, 4: VA.to_layout4}


def append_stream(spark: SparkSession, src: str, out: str, ckpt: str, layout: int = 1,
                  max_files: int | None = None, available_now: bool = True):
    """Start the VCF loader stream; returns the StreamingQuery."""
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files or 1000).load(src)
             .select(F.col("_metadata.file_path").alias("file_id"), F.col("value").alias("line")))

    def load(batch: DataFrame, batch_id: int) -> None:
        rec, rejects = read_vcf(batch.sparkSession, None, lines=batch)
        rec = written_once(rec, "stream-records")  # text is parsed once for all tables of the layout
        target = f"{out}/batch_id={batch_id}"
        VA.write_layout(LAYOUTS[layout](rec, ordered=True), target, layout, ordered=True)
        rejects.write.mode("overwrite").parquet(f"{target}/rejects")
        batch.sparkSession.range(1).write.mode("overwrite").parquet(f"{out}/commits/batch_id={batch_id}")

    w = lines.writeStream.foreachBatch(load).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def loaded(spark: SparkSession, out: str, layout: int, name: str) -> DataFrame:
    """A table of the loader: the rows of committed batches."""
    done = spark.read.parquet(f"{out}/commits").select("batch_id").distinct()
    rows = spark.read.parquet(f"{out}/batch_id=*/layout{layout}/{name}")
    batch = F.regexp_extract(F.col("_metadata.file_path"), "/batch_id=([0-9]+)/", 1).cast("long")
    return rows.withColumn("_batch", batch).join(done.select(F.col("batch_id").cast("long").alias("_batch")), "_batch", "left_semi").drop("_batch")


#: Batches between two snapshots of a compacted table.
COMPACT_EVERY = 8


def upsert_batch(rows: DataFrame, batch_id: int, path: str, merge, every: int = COMPACT_EVERY) -> None:
    """Add a micro-batch to the compacted table under ``path``.

    A batch overwrites one of ``every`` fixed delta folders. The last batch of a cycle merges the
    newest snapshot with the cycle's deltas (``merge``: DataFrame -> DataFrame, keeping one row per
    key) and overwrites the older of two snapshot folders; a head row that names it is written
    last. So there are ``every`` + 4 folders for ever, a reader always finds a whole snapshot, and
    a batch that is replayed after a failure writes the same rows to the same places again.
    """
    spark = rows.sparkSession
    rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/delta/slot{batch_id % every}")
    if (batch_id + 1) % every == 0:
        slot = batch_id // every % 2
        merged = compacted(spark, path, merge, before=batch_id)
        merged.write.mode("overwrite").parquet(f"{path}/snapshot/slot{slot}")
        spark.range(1).select(F.lit(slot).alias("slot"), F.lit(batch_id).cast("long").alias("upto")).write.mode("overwrite").parquet(f"{path}/head/slot{slot}")


def _slots(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the folders ``path/slot*``; None if there are none yet."""
    try:
        return spark.read.parquet(f"{path}/slot*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def compacted(spark: SparkSession, path: str, merge, before: int | None = None) -> DataFrame:
    """The compacted table: the newest snapshot (of a batch before ``before``, if given) and the
    deltas after it, merged. Reads one snapshot and at most a cycle of deltas."""
    heads = _slots(spark, f"{path}/head")
    head = None if heads is None else heads.filter(F.lit(True) if before is None else F.col("upto") < before).orderBy(F.desc("upto")).first()
    delta = _slots(spark, f"{path}/delta").filter(F.col("batch_id") > (-1 if head is None else head["upto"]))
    delta = delta.drop("batch_id")
    return merge(delta if head is None else delta.unionByName(spark.read.parquet(f"{path}/snapshot/slot{head['slot']}")))


def status_stream(spark: SparkSession, events: DataFrame, out: str, ckpt: str, window: str = "1 hour",
                  watermark: str = "2 hours", available_now: bool = True, every: int = COMPACT_EVERY):
    """``events``: streaming DataFrame (run_id, ts, status). Keeps ``out/counts`` (counts per window
    and status) and ``out/latest`` (latest status per run) as compacted tables, read by
    ``current_counts`` and ``current_latest``. Rows later than the watermark are not counted."""
    e = events.withWatermark("ts", watermark)
    counts = e.groupBy(F.window("ts", window).alias("w"), "status").agg(F.count("*").alias("n")).select(
        F.unix_timestamp(F.col("w.start")).alias("window_start"), "status", "n")

    def put_counts(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, f"{out}/counts", highest_counts, every)

    def put_latest(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(latest_status(batch.select("run_id", "status", F.col("ts").alias("last_ts"))), batch_id, f"{out}/latest", latest_status, every)

    qs = []
    for name, df, mode, put in (("counts", counts, "update", put_counts), ("latest", events, "append", put_latest)):
        w = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{ckpt}/{name}")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        qs.append(w.start())
    return qs


def latest_status(rows: DataFrame) -> DataFrame:
    """Last status per run by event time (ties: the larger status)."""
    return rows.groupBy("run_id").agg(F.max_by("status", F.struct("last_ts", "status")).alias("status"), F.max("last_ts").alias("last_ts"))


def highest_counts(rows: DataFrame) -> DataFrame:
    """Newest count per window and status: counts of a window only grow."""
    return rows.groupBy("window_start", "status").agg(F.max("n").alias("n"))


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    return compacted(spark, f"{out}/counts", highest_counts)


def current_latest(spark: SparkSession, out: str) -> DataFrame:
    return compacted(spark, f"{out}/latest", latest_status)
