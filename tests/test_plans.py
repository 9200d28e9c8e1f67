"""Entry A end to end, and plan-shape regressions for every registered query."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabprep import constants as K
from tabprep.operators import quality as Q
from tabprep.operators import schema as S
from tabprep.plans.curate import run_curate
from tabprep.registry import ORACLE, QUERIES, raw
from tabprep.sources import io


def test_run_curate_from_messy_csv(spark, tmp_dir):
    # a CSV with messy headers and an extra column, as the source job receives it
    r = raw(spark, SF001)
    messy = r.select(*[F.col(c).alias("  " + c.upper().replace("_", "-") + " ") for c in K.CONTRACT_COLUMNS],
                     F.col("record_id").alias("Record ID"), F.col("copy_no").alias("copy no"))
    path = os.path.join(tmp_dir, "src")
    messy.write.option("header", "true").csv(path)
    src = io.read_raw_csv(spark, path)
    res = run_curate(src, "curate_test.curated", "curate_test.dq", tie_break=["record_id", "copy_no"],
                     source_path=path, now="2024-01-01 00:00:00", enforce_gates=["label_drift", "empty_result"])
    assert res.published_rows == 1499
    assert spark.table("curate_test.curated").columns == K.CURATED_COLUMNS + ["processed_at"]
    m = {r["metric_name"]: r["metric_value"] for r in spark.table("curate_test.dq").collect()}
    assert m["raw_row_count"] == 1560 and m["curated_row_count"] == 1499 and m["invalid_token_count"] == 239
    gates = {r["gate"]: r["passed"] for r in res.gates.collect()}
    assert gates["label_drift"] and not gates["invalid_age"]
    with pytest.raises(Q.GateError):
        run_curate(src, tie_break=["record_id", "copy_no"], enforce_gates=["invalid_age"])
    with pytest.raises(Q.GateError):  # all gates are the default, and nothing is published past them
        run_curate(src, "curate_test.never", tie_break=["record_id", "copy_no"])
    assert not spark.catalog.tableExists("curate_test.never")


def test_run_curate_rejects_missing_contract(spark):
    with pytest.raises(S.ContractError):
        run_curate(raw(spark, SF001).drop("income"))


def test_run_curate_audit_profile(spark):
    res = run_curate(raw(spark, SF001), profile="audit", tie_break=["record_id", "copy_no"], now="2024-01-01 00:00:00",
                     enforce_gates=False)
    assert "income_label" in res.curated.columns and "pipeline_version" in res.curated.columns
    names = {r["metric_name"] for r in res.dq_metrics.collect()}
    assert {"error_token_count", "age_cast_failures", "null_count__pipeline_version"} <= names


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line or "Scan ExistingRDD" in line for line in plan.splitlines())


def test_one_clean_serves_the_whole_job(spark, tmp_dir):
    path = os.path.join(tmp_dir, "src")
    raw(spark, SF001).write.parquet(path)
    src = spark.read.parquet(path)
    staged = Q.dq_frame(src, "core")
    assert scans(staged) == 1
    res = run_curate(src, enforce_gates=False)
    for df in (res.curated, res.gates, res.dq_metrics):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert path not in " ".join(df.inputFiles()) and plan  # later steps read the written copies
    assert scans(Q.duplicate_count(src)) == scans(Q.dedup_impact(src, ["age", "sex"])) == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_cartesian_products(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedup_combines_map_side(spark):
    plan = QUERIES["dedup_by_key"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the shuffle, final above it
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2


def test_top_values_limits_map_side(spark):
    plan = QUERIES["top_values_lineitem"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_is_pruned(spark):
    plan = QUERIES["model_frame_compact6"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    orders_scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "o_orderkey" in line][0]
    assert "o_orderdate" in orders_scan and "o_comment" not in orders_scan
