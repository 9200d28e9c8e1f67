"""Large vocabularies, mergeable sketches, concurrent fits, the run log as the source of the comparison, and single evaluation of the
time cascade."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabprep.operators import prep as M
from tabprep.operators import profile as P
from tabprep.operators.features import build_features
from tabprep.operators.partitioning import materialize
from tabprep.plans import train as TR
from tabprep.plans.clean import clean
from tabprep.plans.curate import run_curate
from tabprep.registry import KEEP, curated, raw


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# ------------------------------------------------------------------ M02, M06
def test_vocabulary_of_many_values(spark):
    n = 100_000
    df = spark.range(n + 10).select(F.concat(F.lit("v"), (F.col("id") % n)).alias("c"))  # ten values occur twice
    vocabulary = M.vocabulary_table(df, ["c"])
    row = vocabulary.agg(F.count(F.lit(1)), F.countDistinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(row) == (n, n, 0.0, n - 1.0)
    first = [r["value"] for r in vocabulary.where("index < 10").orderBy("index").collect()]
    assert first == [f"v{k}" for k in range(10)]
    after = [r["value"] for r in vocabulary.where("index >= 10 AND index < 13").orderBy("index").collect()]
    assert after == sorted(f"v{k}" for k in range(10, n))[:3]


def test_vocabulary_table_equals_indexer(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", None), (None, "y"), ("c", "y"), ("", "z")], "p string, q string")
    stage = M.category_stages(["p", "q"])[0].fit(df)
    new = spark.createDataFrame([("b", "x"), (None, None), ("new", "z"), ("", "y")], "p string, q string")
    expected = sorted(map(tuple, stage.transform(new).select("p", "q", "p_idx", "q_idx").collect()), key=str)
    got = M.index_by_table(new, ["p", "q"], M.vocabulary_table(df, ["p", "q"]))
    assert sorted(map(tuple, got.select("p", "q", "p_idx", "q_idx").collect()), key=str) == expected


def test_vocabulary_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "c string")
    vocabulary = M.vocabulary_table(df, ["c"])
    assert vocabulary.count() == 0
    assert M.index_by_table(df, ["c"], vocabulary).first()["c_idx"] == 0.0


# ------------------------------------------------------------------ A11, A15
def test_merged_sketches_equal_whole(spark):
    df = spark.range(50_000).select((F.col("id") % 7).alias("day"), F.col("id").alias("a"), (F.col("id") % 100).cast("string").alias("b"))
    merged = {r["column_name"]: r for r in P.sketch_summary(P.sketch_states(df, by=["day"])).collect()}
    whole = {r["column_name"]: r for r in P.sketch_summary(P.sketch_states(df.drop("day"))).collect()}
    for c in ("a", "b"):
        assert merged[c]["row_count"] == whole[c]["row_count"] == 50_000
        assert merged[c]["approx_distinct"] == pytest.approx(whole[c]["approx_distinct"], rel=0.02)
    assert merged["a"]["approx_distinct"] == pytest.approx(50_000, rel=0.08)
    assert merged["a"]["p50"] == pytest.approx(25_000, abs=1500) and merged["b"]["p50"] is None


def test_sketches_of_nulls_and_empty(spark):
    schema = "x double, y string"
    nulls = spark.createDataFrame([(None, None), (float("nan"), "a")], schema)
    got = {r["column_name"]: r for r in P.sketch_summary(P.sketch_states(nulls)).collect()}
    assert (got["x"]["count"], got["x"]["p50"], got["y"]["count"], got["y"]["approx_distinct"]) == (1, None, 1, 1)
    empty = {r["column_name"]: r for r in P.sketch_summary(P.sketch_states(spark.createDataFrame([], schema))).collect()}
    assert empty["x"]["row_count"] == 0 and empty["x"]["p50"] is None


# ------------------------------------------------------------------ A13, F06
@pytest.mark.parametrize("profile", ["core", "audit"])
def test_job_over_no_rows(spark, profile):
    res = run_curate(raw(spark, SF001).where("record_id < 0"), profile=profile, tie_break=KEEP, enforce_gates=False)
    metrics = {r["metric_name"]: r["metric_value"] for r in res.dq_metrics.collect()}
    assert metrics["raw_row_count"] == metrics["curated_row_count"] == metrics["raw_duplicate_count"] == 0


# ----------------------------------------------------------------------- N07
def test_concurrent_fits_equal_sequential(spark, tmp_dir):
    rows = curated(spark, SF001)
    configs = [TR.ModelConfig(f"lr{k}", "LogisticRegression", {"maxIter": k + 1}) for k in range(3)] + [TR.JOB_CONFIGS["compact_dt"]]
    log = os.path.join(tmp_dir, "log")
    one, many = TR.run_sweep(rows, configs), TR.run_sweep(rows, configs, parallelism=4, log_table=log)
    def plain(res):
        return sorted((r["config_order"], r["run_name"], r["is_best"], *(round(r[c], 9) for c in TR.RUN_FIELDS[3:]))
                      for r in res.runs.collect())
    assert plain(one) == plain(many) and list(one.models) == list(many.models)
    # the stored log holds the same comparison
    board = {r["run_name"]: r for r in TR.logged_leaderboard(spark, log).collect()}
    for r in many.runs.collect():
        assert board[r["run_name"]]["is_best"] == r["is_best"]
        assert [board[r["run_name"]][c] for c in TR.RUN_FIELDS[3:]] == [r[c] for c in TR.RUN_FIELDS[3:]]


# ------------------------------------------------------------------------ V09
def test_logged_runs_last_value_and_text(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    run = {"run_id": "r/1", "run_name": "x", **{k: 0.5 for k in TR.RUN_FIELDS[3:]}}
    TR.log_run(spark, log, run)
    TR.log_run(spark, log, {**run, "test_roc_auc": 0.75, "roc_auc_overfit_gap": None})
    row = TR.logged_runs(spark, log).collect()
    assert len(row) == 1 and row[0]["run_id"] == "r/1"
    assert row[0]["test_roc_auc"] == 0.75 and row[0]["roc_auc_overfit_gap"] is None


# ------------------------------------------------------------------ E04, F04
def test_time_cascade_is_evaluated_once(spark):
    df = materialize(raw(spark, SF001))
    plan = optimized(build_features(clean(df, "service", keep=KEEP), keep=KEEP))
    assert plan.count("transform(") == 1
