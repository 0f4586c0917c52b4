"""Compacted stream tables: any number of batches, replays, and what a reader opens."""

import os
import random

from pyspark.sql import functions as F

from helixspark.streaming import jobs as J


def _events(n, seed=2):
    rnd = random.Random(seed)
    return [(rnd.randint(0, 30), rnd.randint(0, 5000), rnd.choice(["RUNNING", "DONE", "FAILED"])) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "run_id long, last_ts long, status string")


def _folders(path):
    return {f"{d}/{x}" for d in os.listdir(path) for x in os.listdir(f"{path}/{d}")}


def test_any_number_of_batches(spark, tmp_dir):
    rows = _events(260)
    for b in range(26):
        part = rows[b * 10:(b + 1) * 10]
        J.upsert_batch(J.latest_status(_frame(spark, part)), b, tmp_dir, J.latest_status, every=4)
        if b in (0, 3, 4, 11, 25):
            J.upsert_batch(J.latest_status(_frame(spark, part)), b, tmp_dir, J.latest_status, every=4)  # replayed
            want = {k: max((t, s) for i, t, s in rows[:(b + 1) * 10] if i == k) for k in {r[0] for r in rows[:(b + 1) * 10]}}
            got = J.compacted(spark, tmp_dir, J.latest_status)
            assert {r.run_id: (r.last_ts, r.status) for r in got.collect()} == want
            assert len(_folders(tmp_dir)) <= 4 + 4
    opened = {os.path.dirname(f) for f in got.inputFiles()}
    assert len(opened) <= 1 + 4


def test_stream_of_many_files(spark, tmp_dir):
    rows = [(i % 7, 1_700_000_000 + 400 * i, "DONE" if i % 3 else "RUNNING") for i in range(90)]
    schema = "run_id long, ts timestamp, status string"
    for k in range(9):
        df = _frame(spark, rows[k * 10:(k + 1) * 10]).select("run_id", F.timestamp_seconds("last_ts").alias("ts"), "status")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src")
    for q in J.status_stream(spark, ev, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", every=3, watermark="1000 days"):
        q.awaitTermination()
    latest = {r.run_id: (r.s, r.status) for r in J.current_latest(spark, f"{tmp_dir}/out").select("run_id", "status", F.unix_timestamp("last_ts").alias("s")).collect()}
    assert latest == {k: max((t, s) for i, t, s in rows if i == k) for k in range(7)}
    counts = {(r.window_start, r.status): r.n for r in J.current_counts(spark, f"{tmp_dir}/out").collect()}
    want = {}
    for _, t, s in rows:
        want[t // 3600 * 3600, s] = want.get((t // 3600 * 3600, s), 0) + 1
    assert counts == want
