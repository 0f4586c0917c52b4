"""Registered run-analytics queries over the f2_tasks view (task log in epoch seconds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixspark.operators import runs as R
from helixspark.plans.fixtures import fixture, with_views
from helixspark.plans.registry import register


def _catalog_sql() -> str:
    rows = ", ".join(
        f"('omics.{f}.{s}large', {v}, {v * m}, {si}, {fi})"
        for si, (s, v) in enumerate(R.SIZES) for fi, (f, m) in enumerate(R.FAMILIES))
    return f"catalog(instance, vcpus, mem, size_rank, fam_rank) as (values {rows})"


def _prices_sql(spark=None) -> str:
    rate = {"c": 0.0425, "m": 0.0540, "r": 0.0700}
    rows = [f"('omics.{f}.{s}large', {round(v * rate[f], 6)})" for s, v in R.SIZES for f, _ in R.FAMILIES]
    rows.append("('Run Storage', 0.0001918)")
    return f"prices(resource_type, usd_per_hour) as (values {', '.join(rows)})"


def _pick_sql(cpus: str, mem: str, src: str, name: str) -> str:
    """Oracle form of the instance choice: theta join to the catalog + arg_min."""
    return f"""{name} as (
  select d.c as cpus, d.m as memory, coalesce(arg_min(k.instance, k.size_rank * 10 + k.fam_rank), '') as instance
  from (select distinct {cpus} as c, {mem} as m from {src} where {cpus} is not null) d
  left join catalog k on k.vcpus >= d.c and k.mem >= d.m
  group by d.c, d.m)"""


TASK_COSTS_SQL = f""", {_catalog_sql()}, {_prices_sql()},
{_pick_sql('cpus', 'memory', 'f2_tasks', 'pick')},
tc as (
  select t.*, p.instance,
    case when t.cpus is not null and t.cpus > 0 and t.memory > 0 and t.stop_s is not null
         then (t.stop_s - t.start_s) / 3600.0 else 0.0 end as duration_hr,
    pr.usd_per_hour
  from f2_tasks t left join pick p on p.cpus = t.cpus and p.memory = t.memory
  left join prices pr on pr.resource_type = p.instance),
tc2 as (select *, case when cpus is not null and cpus > 0 then duration_hr * usd_per_hour else 0.0 end as cost from tc)
"""


@register("instance_pick", with_views(f""", {_catalog_sql()},
{_pick_sql('cpus', 'memory', 'f2_tasks', 'p1')},
{_pick_sql('cpus * 4', 'memory * 2', 'f2_tasks', 'p2')}
select t.task_id, t.cpus, t.memory, p1.instance, p2.instance as instance_big
from f2_tasks t join p1 on p1.cpus = t.cpus and p1.memory = t.memory
join p2 on p2.cpus = t.cpus * 4 and p2.memory = t.memory * 2""", "f2_tasks"))
def q_instance_pick(spark, sf):
    t = fixture(spark, sf, "f2_tasks").filter(F.col("cpus").isNotNull())
    return t.select(
        "task_id", "cpus", "memory", R.pick_instance("cpus", "memory").alias("instance"),
        R.pick_instance(F.col("cpus") * 4, F.col("memory") * 2).alias("instance_big"))


RUNS_SQL = """runs as (
  select run_id, min(start_s) as start_s, max(stop_s) as stop_s,
    case run_id % 4 when 0 then null when 1 then 500 when 2 then 1200 else 2400 end as storage_gib
  from f2_tasks group by run_id)"""


def _runs(t):
    return t.groupBy("run_id").agg(F.min("start_s").alias("start_s"), F.max("stop_s").alias("stop_s")).withColumn(
        "storage_gib",
        F.when(F.col("run_id") % 4 == 1, 500).when(F.col("run_id") % 4 == 2, 1200)
        .when(F.col("run_id") % 4 == 3, 2400))


@register("run_cost", with_views(TASK_COSTS_SQL + f""", {RUNS_SQL},
agg as (select run_id, sum(cost) as total_task_cost, sum(duration_hr) as total_task_duration_hr from tc2 group by run_id)
select r.run_id, greatest(coalesce(r.storage_gib, 1200), 1200) as storage_gib,
  round((r.stop_s - r.start_s) / 3600.0 * greatest(coalesce(r.storage_gib, 1200), 1200) * 0.0001918, 6) as storage_cost,
  round(a.total_task_cost, 6) as total_task_cost, round(a.total_task_duration_hr, 6) as total_task_duration_hr,
  round((r.stop_s - r.start_s) / 3600.0 * greatest(coalesce(r.storage_gib, 1200), 1200) * 0.0001918 + a.total_task_cost, 6) as total
from runs r left join agg a on a.run_id = r.run_id""", "f2_tasks"))
def q_run_cost(spark, sf):
    t = fixture(spark, sf, "f2_tasks")
    out = R.run_cost(_runs(t), t, R.example_prices(spark))
    return out.select(
        "run_id", "storage_gib", F.round("storage_cost", 6).alias("storage_cost"),
        F.round("total_task_cost", 6).alias("total_task_cost"),
        F.round("total_task_duration_hr", 6).alias("total_task_duration_hr"), F.round("total", 6).alias("total"))


@register("task_timeline", with_views(""", tare as (select run_id, min(created_s) as t0 from f2_tasks group by run_id)
select t.task_id, t.run_id, t.status,
  round((t.start_s - a.t0) / 60.0, 6) as running_left, round((t.stop_s - t.start_s) / 60.0, 6) as running_duration,
  round((t.created_s - a.t0) / 60.0, 6) as queued_left, round((t.start_s - t.created_s) / 60.0, 6) as queued_duration,
  round(t.memory / nullif(t.cpus, 0), 6) as memory_to_cpus
from f2_tasks t join tare a on a.run_id = t.run_id""", "f2_tasks"))
def q_timeline(spark, sf):
    t = R.timeline(fixture(spark, sf, "f2_tasks"), "min")
    return t.select(
        "task_id", "run_id", "status", *[F.round(c, 6).alias(c) for c in (
            "running_left", "running_duration", "queued_left", "queued_duration", "memory_to_cpus")])


@register("wall_time", with_views(TASK_COSTS_SQL + """
select run_id, count(*) as n_tasks, max(stop_s) - min(created_s) as wall_s, max(cpus) as max_cpus,
  max(memory) as max_memory, round(sum(cost), 6) as total_cost
from tc2 group by run_id""", "f2_tasks"))
def q_wall_time(spark, sf):
    t = R.run_totals(fixture(spark, sf, "f2_tasks"), R.example_prices(spark))
    return t.select("run_id", "n_tasks", F.col("wall_s").cast("long").alias("wall_s"), "max_cpus", "max_memory",
                    F.round("total_cost", 6).alias("total_cost"))


@register("task_stats", with_views(TASK_COSTS_SQL + f""",
g as (
  select regexp_replace(name, '(-[0-9]+|\\s*\\([0-9]+\\))$', '') as name, count(*) as cnt,
    avg(stop_s - start_s) as mean_s, max(stop_s - start_s) as max_s, stddev_samp(stop_s - start_s) as sd_s,
    max(cost) as max_usd, avg(cost) as mean_usd,
    cast(ceil(max(cpus) * 1.1) as bigint) as rc, cast(ceil(max(memory) * 1.1) as bigint) as rm
  from tc2 group by 1),
{_pick_sql('rc', 'rm', 'g', 'rp')}
select g.name, g.cnt as count, round(g.mean_s, 6) as meanRunningSeconds, round(cast(g.max_s as double), 6) as maximumRunningSeconds,
  round(g.sd_s, 6) as stdDevRunningSeconds, round(g.max_usd, 6) as maximumEstimatedUSD, round(g.mean_usd, 6) as meanEstimatedUSD,
  g.rc as recommendedCpus, g.rm as recommendedMemoryGiB, rp.instance as recommendOmicsInstanceType
from g left join rp on rp.cpus = g.rc and rp.memory = g.rm""", "f2_tasks"))
def q_task_stats(spark, sf):
    s = R.task_stats(fixture(spark, sf, "f2_tasks"), R.example_prices(spark), 0.1)
    return s.select(
        "name", "count", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in (
            "meanRunningSeconds", "maximumRunningSeconds", "stdDevRunningSeconds", "maximumEstimatedUSD",
            "meanEstimatedUSD")],
        "recommendedCpus", "recommendedMemoryGiB", "recommendOmicsInstanceType")
