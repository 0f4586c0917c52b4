"""Workflow-run analytics over task logs: instance choice, cost, timeline, totals, stats.

Task log columns: ``run_id, task_id, name, status, cpus, memory (GiB), [gpus],
[instance_type], created, start, stop`` where the three times are epoch seconds or
timestamps (``*_s`` names for seconds are accepted through ``cols``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the instance catalog: size suffix -> vCPUs, family -> GiB per vCPU,
# searched smallest size first, then family c, m, r.
SIZES = [("", 2), ("x", 4), ("2x", 8), ("4x", 16), ("8x", 32), ("12x", 48), ("16x", 64), ("24x", 96)]
FAMILIES = [("c", 2), ("m", 4), ("r", 8)]
MIN_STORAGE_GIB = 1200
TIME_SCALE = {"sec": 1.0, "min": 1 / 60, "hr": 1 / 3600, "day": 1 / 86400}


def _secs(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(c)) / F.lit(1e6)
    return F.col(c).cast("double")


def pick_instance(cpus, memory) -> Column:
    """Smallest instance with vcpu >= cpus and memory >= memory ('' when none fits).

    A closed form over the 8 sizes (no join, codegen friendly): for each family the
    first size with ``vcpu >= max(cpus, memory / gib_per_vcpu)`` (a CASE chain);
    the smallest size wins, ties go to c, then m, then r (``least`` of structs).
    """
    cpus = F.col(cpus) if isinstance(cpus, str) else cpus
    memory = F.col(memory) if isinstance(memory, str) else memory
    cands = []
    for rank, (fam, mult) in enumerate(FAMILIES):
        need = F.greatest(cpus.cast("double"), memory.cast("double") / F.lit(float(mult)))
        size = None
        for rank_s, (suffix, v) in enumerate(SIZES):
            cond = need <= F.lit(float(v))
            pick = F.struct(F.lit(rank_s).alias("s"), F.lit(rank).alias("f"),
                            F.lit(f"omics.{fam}.{suffix}large").alias("name"))
            size = F.when(cond, pick) if size is None else size.when(cond, pick)
        cands.append(size)
    best = F.least(*cands)
    return F.coalesce(best["name"], F.lit(""))


def example_prices(spark: SparkSession, storage_usd_gib_hr: float = 0.0001918) -> DataFrame:
    """A price list in the shape ``read_prices`` returns (resource_type, usd_per_hour).

    Illustrative rates (per vCPU-hour by family); real runs pass the price list
    read from the provider's JSON instead.
    """
    rate = {"c": 0.0425, "m": 0.0540, "r": 0.0700}
    rows = [(f"omics.{f}.{s}large", round(v * rate[f], 6)) for s, v in SIZES for f, _ in FAMILIES]
    rows.append(("Run Storage", storage_usd_gib_hr))
    return spark.createDataFrame(rows, "resource_type string, usd_per_hour double")


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price JSON (products / terms.OnDemand / priceDimensions) -> (resource_type, usd_per_hour).

    Keeps products of family Compute; takes the first term and its first price
    dimension. Product and term keys are dynamic, so they are read as maps.
    """
    schema = (
        "products map<string, struct<productFamily:string, attributes:map<string,string>>>, "
        "terms struct<OnDemand: map<string, map<string, struct<priceDimensions: "
        "map<string, struct<pricePerUnit: map<string,string>>>>>>>"
    )
    j = spark.read.schema(schema).option("multiLine", True).json(path)
    prods = j.select(F.explode("products").alias("sku", "p"), F.col("terms.OnDemand").alias("od"))
    prods = prods.filter(F.col("p.productFamily") == "Compute")
    # first term, first dimension (maps keep file order of keys)
    term = F.get(F.map_values(F.col("od")[F.col("sku")]), 0)
    dim = F.get(F.map_values(term["priceDimensions"]), 0)
    return prods.select(
        F.col("p.attributes")["resourceType"].alias("resource_type"),
        dim["pricePerUnit"]["USD"].cast("double").alias("usd_per_hour"),
    ).filter(F.col("resource_type").isNotNull())


def _norm_tasks(tasks: DataFrame, cols: dict | None) -> DataFrame:
    cols = {"created": "created_s", "start": "start_s", "stop": "stop_s", **(cols or {})}
    t = tasks
    for k, c in cols.items():
        t = t.withColumn(f"_{k}", _secs(tasks, c))
    if "gpus" not in t.columns:
        t = t.withColumn("gpus", F.lit(0))
    if "instance_type" not in t.columns:
        t = t.withColumn("instance_type", F.lit(None).cast("string"))
    return t


def task_costs(tasks: DataFrame, prices: DataFrame, cols: dict | None = None) -> DataFrame:
    """Per task: duration (h), instance, usd/h and cost. Unsized tasks cost 0 and
    last 0 h; a task without stop time lasts 0 h. The price list is a bounded
    lookup (one row per instance type), so the join is broadcast."""
    t = _norm_tasks(tasks, cols)
    sized = F.col("cpus").isNotNull() & (F.col("cpus") > 0) & F.col("memory").isNotNull() & (F.col("memory") > 0)
    t = t.withColumn("_sized", sized).withColumn(
        "instance",
        F.when(sized, F.coalesce(F.col("instance_type"), pick_instance("cpus", "memory"))),
    ).withColumn(
        "duration_hr",
        F.when(sized & F.col("_stop").isNotNull(), (F.col("_stop") - F.col("_start")) / 3600.0).otherwise(0.0),
    )
    p = F.broadcast(prices.select(F.col("resource_type").alias("instance"), "usd_per_hour"))
    t = t.join(p, "instance", "left")
    return t.withColumn("cost", F.when(F.col("_sized"), F.col("duration_hr") * F.col("usd_per_hour")).otherwise(0.0))


def run_cost(runs: DataFrame, tasks: DataFrame, prices: DataFrame, cols: dict | None = None) -> DataFrame:
    """Per run: storage cost (duration x max(1200, capacity) GiB x price) + task costs.

    ``runs``: run_id, start_s, stop_s, storage_gib (null -> 1200). Task costs are
    summed per run with map-side partial aggregation.
    """
    tc = task_costs(tasks, prices, cols).groupBy("run_id").agg(
        F.sum("cost").alias("total_task_cost"), F.sum("duration_hr").alias("total_task_duration_hr"),
        F.count("*").alias("n_tasks"))
    storage_price = F.broadcast(prices.filter(F.col("resource_type") == "Run Storage").select(
        F.col("usd_per_hour").alias("storage_usd_gib_hr")))
    r = runs.withColumn("storage_gib", F.greatest(F.coalesce(F.col("storage_gib"), F.lit(MIN_STORAGE_GIB)),
                                                  F.lit(MIN_STORAGE_GIB)))
    r = r.withColumn("run_duration_hr", (F.col("stop_s") - F.col("start_s")) / 3600.0)
    r = r.withColumn("_res", F.lit("Run Storage")).join(
        storage_price.withColumn("_res", F.lit("Run Storage")), "_res", "left").drop("_res")
    r = r.withColumn("storage_cost", F.col("run_duration_hr") * F.col("storage_gib") * F.col("storage_usd_gib_hr"))
    out = r.join(tc, "run_id", "left").fillna(0.0, ["total_task_cost", "total_task_duration_hr"])
    return out.withColumn("total", F.col("storage_cost") + F.col("total_task_cost"))


def timeline(tasks: DataFrame, unit: str = "min", prices: DataFrame | None = None, cols: dict | None = None) -> DataFrame:
    """Per task offsets from the earliest creation of its run, in ``unit``.

    The run start is a grouped min joined back (not a window), so one huge run is
    not pulled into a single task.
    """
    k = TIME_SCALE[unit]
    t = _norm_tasks(tasks, cols)
    tare = t.groupBy("run_id").agg(F.min("_created").alias("_tare"))
    t = t.join(tare, "run_id")
    t = (
        t.withColumn("running_left", (F.col("_start") - F.col("_tare")) * k)
        .withColumn("running_right", (F.col("_stop") - F.col("_tare")) * k)
        .withColumn("running_duration", F.col("running_right") - F.col("running_left"))
        .withColumn("queued_left", (F.col("_created") - F.col("_tare")) * k)
        .withColumn("queued_right", F.col("running_left"))
        .withColumn("queued_duration", F.col("queued_right") - F.col("queued_left"))
        .withColumn("memory_to_cpus", F.try_divide(F.col("memory").cast("double"), F.col("cpus")))
    )
    if prices is not None:
        p = F.broadcast(prices.select(F.col("resource_type").alias("_inst"), F.col("usd_per_hour").alias("_usd")))
        t = t.withColumn("_inst", F.coalesce(F.col("instance_type"), pick_instance("cpus", "memory")))
        t = t.join(p, "_inst", "left").withColumn(
            "cost_usd", F.col("running_duration") / F.lit(k) / 3600.0 * F.col("_usd")).drop("_inst", "_usd")
    return t.drop("_tare", "_created", "_start", "_stop")


def run_totals(tasks: DataFrame, prices: DataFrame | None = None, cols: dict | None = None) -> DataFrame:
    """Per run: task count, wall time (max stop - min creation), max cpus, max memory, cost."""
    t = task_costs(tasks, prices, cols) if prices is not None else _norm_tasks(tasks, cols).withColumn("cost", F.lit(0.0))
    return t.groupBy("run_id").agg(
        F.count("*").alias("n_tasks"),
        (F.max("_stop") - F.min("_created")).alias("wall_s"),
        F.max("cpus").alias("max_cpus"),
        F.max("memory").alias("max_memory"),
        F.sum("cost").alias("total_cost"),
    )


def base_name(name) -> Column:
    """Task name without a scatter suffix (``-3`` or `` (3)``)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(c, r"(-\d+|\s*\(\d+\))$", "")


def task_stats(tasks: DataFrame, prices: DataFrame, headroom: float = 0.1, cols: dict | None = None) -> DataFrame:
    """Per task base name: counts, running-time moments, reserved resources, cost,
    and recommended cpus / memory (``ceil(max_used * (1 + headroom))``) and instance.

    Without utilisation metrics the reserved amounts stand in for the used ones.
    """
    t = task_costs(tasks, prices, cols).withColumn("_run_s", F.col("_stop") - F.col("_start"))
    if "cpu_used" not in t.columns:
        t = t.withColumn("cpu_used", F.col("cpus").cast("double"))
    if "memory_used" not in t.columns:
        t = t.withColumn("memory_used", F.col("memory").cast("double"))
    g = t.groupBy(base_name("name").alias("name")).agg(
        F.count("*").alias("count"),
        F.avg("_run_s").alias("meanRunningSeconds"),
        F.max("_run_s").alias("maximumRunningSeconds"),
        F.stddev_samp("_run_s").alias("stdDevRunningSeconds"),
        F.max(F.col("gpus")).alias("maximumGpusReserved"),
        F.avg(F.col("gpus")).alias("meanGpusReserved"),
        F.max("cpu_used").alias("_max_cpu"),
        F.max("memory_used").alias("_max_mem"),
        F.max("cost").alias("maximumEstimatedUSD"),
        F.avg("cost").alias("meanEstimatedUSD"),
    )
    # round away binary noise before ceil (90 * 1.1 must give 99, not 100)
    g = g.withColumn("recommendedCpus", F.ceil(F.round(F.col("_max_cpu") * (1 + headroom), 9)).cast("long")).withColumn(
        "recommendedMemoryGiB", F.ceil(F.round(F.col("_max_mem") * (1 + headroom), 9)).cast("long"))
    g = g.withColumn("recommendOmicsInstanceType", pick_instance("recommendedCpus", "recommendedMemoryGiB"))
    return g.withColumn("type", F.lit("task")).drop("_max_cpu", "_max_mem")
