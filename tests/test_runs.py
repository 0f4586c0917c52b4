"""Run analytics: instance choice and cost edge cases."""

from pyspark.sql import functions as F

from helixspark.operators import runs as R


def test_instance_pick_cases(spark):
    df = spark.createDataFrame([(2, 4.0), (2, 9.0), (4, 9.0), (97, 1.0)], "cpus int, memory double")
    got = [r[0] for r in df.select(R.pick_instance("cpus", "memory")).collect()]
    assert got == ["omics.c.large", "omics.r.large", "omics.m.xlarge", ""]


def test_cost_edge_cases(spark):
    prices = R.example_prices(spark)
    tasks = spark.createDataFrame([
        (1, 1, "a", "COMPLETED", 2, 4, 0, 0, 3600),
        (1, 2, "b", "RUNNING", 2, 4, 0, 0, None),  # no stop -> 0 h
        (1, 3, "c", "COMPLETED", None, 4, 0, 0, 3600),  # no cpus -> 0 cost
    ], "run_id int, task_id int, name string, status string, cpus int, memory int, created_s long, start_s long, "
       "stop_s long")
    tc = {r["task_id"]: r for r in R.task_costs(tasks, prices).collect()}
    assert tc[1]["duration_hr"] == 1.0 and abs(tc[1]["cost"] - 0.085) < 1e-9
    assert tc[2]["duration_hr"] == 0.0 and tc[2]["cost"] == 0.0
    assert tc[3]["cost"] == 0.0
    runs = spark.createDataFrame([(1, 0, 3600, 500)], "run_id int, start_s long, stop_s long, storage_gib int")
    rc = R.run_cost(runs, tasks, prices).first()
    assert rc["storage_gib"] == 1200
    assert abs(rc["storage_cost"] - 1200 * 0.0001918) < 1e-12


def test_read_prices(spark, tmp_dir):
    import json

    doc = {"products": {"SKU1": {"productFamily": "Compute", "attributes": {"resourceType": "omics.c.large"}},
                        "SKU2": {"productFamily": "Storage", "attributes": {"resourceType": "Run Storage"}}},
           "terms": {"OnDemand": {"SKU1": {"T1": {"priceDimensions": {"D1": {"pricePerUnit": {"USD": "0.1"}}}}},
                                  "SKU2": {"T2": {"priceDimensions": {"D2": {"pricePerUnit": {"USD": "0.2"}}}}}}}}
    p = f"{tmp_dir}/prices.json"
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    got = {r[0]: r[1] for r in R.read_prices(spark, p).collect()}
    assert got == {"omics.c.large": 0.1}


def test_timeline_offsets(spark):
    t = spark.createDataFrame([(1, 1, "a", "COMPLETED", 2, 8, 100, 160, 280), (1, 2, "b", "FAILED", 2, 8, 40, 60, 100)],
                              "run_id int, task_id int, name string, status string, cpus int, memory int, "
                              "created_s long, start_s long, stop_s long")
    r = {x["task_id"]: x for x in R.timeline(t, "min").collect()}
    assert r[2]["queued_left"] == 0.0 and r[1]["running_left"] == 2.0 and r[1]["memory_to_cpus"] == 4.0
    assert R.base_name(F.lit("task (3)")) is not None
