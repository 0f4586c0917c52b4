"""Registered streaming queries: each starts a stream with ``availableNow`` over
files Spark derives from the driver tables, waits for it, and returns the table
the stream maintained."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.plans import exports as X
from helixspark.plans.fixtures import fixture, with_views
from helixspark.plans.registry import register
from helixspark.streaming import jobs as J

STATUS_MAP = {"signup": "PENDING", "view": "STARTING", "click": "RUNNING", "error": "FAILED", "purchase": "COMPLETED"}


@register("stream_vcf_append", with_views("""
select sampleid as sample_name, chrom, pos, split_part(sample, ':', 1) as genotype from f1_calls""", "f1_calls"))
def q_stream_vcf(spark, sf):
    src = X.export_vcf(fixture(spark, sf, "f1_calls"), X.fresh_dir(spark, "stream-vcf-src"))
    out, ckpt = X.fresh_dir(spark, "stream-vcf-out"), X.fresh_dir(spark, "stream-vcf-ckpt")
    q = J.append_stream(spark, src, out, ckpt, layout=1)
    q.awaitTermination()
    s = J.loaded(spark, out, 1, "samples").select("sample_id", "sample_name").distinct()
    v = J.loaded(spark, out, 1, "variants").select("variant_id", "chrom", "pos").dropDuplicates(["variant_id"])
    return J.loaded(spark, out, 1, "variant_samples").join(s, "sample_id").join(v, "variant_id").select("sample_name", "chrom", "pos", "genotype")


def _status_events(spark, sf):
    ev = fixture(spark, sf, "f9_status")
    path = X.fresh_dir(spark, "stream-status-src")
    m = F.create_map(*[x for k, v in STATUS_MAP.items() for x in (F.lit(k), F.lit(v))])
    ev.select("run_id", "ts", m[F.col("status")].alias("status"), "event_id").write.mode("overwrite").parquet(path)
    schema = "run_id bigint, ts timestamp, status string, event_id bigint"
    return spark.readStream.schema(schema).parquet(path)


def _run_status(spark, sf):
    out, ckpt = X.fresh_dir(spark, "stream-status-out"), X.fresh_dir(spark, "stream-status-ckpt")
    for q in J.status_stream(spark, _status_events(spark, sf), out, ckpt):
        q.awaitTermination()
    return out


_CASE = "case status " + " ".join(f"when '{k}' then '{v}'" for k, v in STATUS_MAP.items()) + " end"


@register("stream_run_status", with_views(f"""
select cast(epoch(time_bucket(interval 1 hour, ts)) as bigint) as window_start, {_CASE} as status, count(*) as n
from f9_status group by 1, 2""", "f9_status"))
def q_stream_status(spark, sf):
    out = _run_status(spark, sf)
    return J.current_counts(spark, out).select("window_start", "status", "n")


@register("stream_run_latest", with_views(f"""
select run_id, arg_max({_CASE}, (ts, {_CASE})) as status, max(ts) as last_ts from f9_status group by run_id""", "f9_status"))
def q_stream_latest(spark, sf):
    out = _run_status(spark, sf)
    return J.current_latest(spark, out).select("run_id", "status", "last_ts")
