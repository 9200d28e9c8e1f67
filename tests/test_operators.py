"""Invariants of the table operators on the dirty fixture and small literals."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabprep import constants as K
from tabprep.operators import dedup as D
from tabprep.operators import evaluate as E
from tabprep.operators import quality as Q
from tabprep.operators import rank as R
from tabprep.operators import schema as S
from tabprep.registry import cleaned, curated, raw


def test_golden_core_counts_sf0001(spark):
    c = cleaned(spark, SF001)
    row = c.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("age").isNull()).alias("age_null"),
        F.count_if(F.col("age") > 120).alias("age_gt"),
        F.count_if(F.col("hours_per_week") > 168).alias("hours_gt"),
        F.count_if(Q.parse_failed("income_raw", "income")).alias("label_fail"),
        F.count_if(Q.parse_failed("event_time", "event_time_std")).alias("time_fail"),
        F.count_if(F.col("workclass") == "Unknown").alias("unknown"),
        F.sum("capital_gain").alias("cg"), F.sum("education_num").alias("en"),
    ).first()
    # golden values for sf0.001 (computed independently in Spark and DuckDB)
    assert row["rows"] == 1560 and row["age_null"] == 252 and row["age_gt"] == 16 and row["hours_gt"] == 46
    assert row["label_fail"] == 260 and row["time_fail"] == 172 and row["unknown"] == 242
    assert row["cg"] == 8412210 and row["en"] == 13124
    assert curated(spark, SF001).count() == 1499
    assert D.dedup_rows(raw(spark, SF001), K.CONTRACT_COLUMNS).count() == 1530


def test_dedup_by_key_one_row_per_key_and_lowest_tiebreak(spark):
    c = cleaned(spark, SF001)
    d = D.dedup_by_key(c, K.BUSINESS_KEY, tie_break=["record_id", "copy_no"])
    assert d.count() == c.select(*K.BUSINESS_KEY).distinct().count()
    assert d.where("copy_no = 1").count() == 0  # copies never survive over their original
    assert d.columns == c.columns


def test_dedup_by_key_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 3, "c")], "k string, t int, v string")
    out = D.dedup_by_key(df, ["k"], tie_break=["t"]).orderBy("t").collect()
    assert [(r.k, r.t, r.v) for r in out] == [(None, 1, "a"), ("x", 3, "c")]


def test_hot_key_dedup_keeps_whole_result(spark):
    # one key holds most rows: the aggregate form still returns one survivor per key
    rows = [("hot", i) for i in range(5000)] + [(f"k{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t int").repartition(8)
    out = D.dedup_by_key(df, ["k"], tie_break=["t"])
    assert out.count() == 101
    assert out.where("k = 'hot'").first()["t"] == 0


def test_hash_split_disjoint_complete(spark):
    c = cleaned(spark, SF001).select("record_id", "copy_no", "income")
    s = D.hash_split(c, ["record_id", "copy_no"])
    assert s.count() == c.count()
    assert set(r.split for r in s.select("split").distinct().collect()) == {"train", "test"}


def test_stratified_split_exact_ratio_and_complete(spark):
    c = cleaned(spark, SF001).select("record_id", "copy_no", "income").where("income IS NOT NULL")
    s = D.stratified_split(c, "income", ["record_id", "copy_no"], 0.2)
    assert s.count() == c.count()
    assert s.select("record_id", "copy_no").distinct().count() == c.select("record_id", "copy_no").distinct().count()
    per = {(r["income"], r["split"]): r["n"] for r in s.groupBy("income", "split").agg(F.count("*").alias("n")).collect()}
    totals = {r["income"]: r["n"] for r in c.groupBy("income").agg(F.count("*").alias("n")).collect()}
    for lab, n in totals.items():
        assert per[(lab, "train")] == round(n * 0.8 + 1e-9)


def test_stratified_split_identical_hot_rows(spark):
    # a third of the rows are identical: they are collapsed, split by count and re-expanded
    rows = [("a", 1)] * 3000 + [("b", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "label string, v int")
    s = D.stratified_split(df, "label", ["v"], 0.2, n_buckets=16)
    got = {(r["label"], r["split"]): r["n"] for r in s.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", "train"): 2400, ("a", "test"): 600, ("b", "train"): 4800, ("b", "test"): 1200}


def test_split_hot_key_in_buckets(spark, monkeypatch):
    # one key holds half of the rows, all distinct: its rows lie in several buckets, in order
    rows = [("a", 7, i) for i in range(2000)] + [("ab"[i % 2], i, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "label string, k int, v int")
    plain = D.stratified_split(df, "label", ["k"], 0.2, n_buckets=4)
    monkeypatch.setattr(R, "BUCKET_ROWS", 300)
    work = df.select("*", R.hash_order(["k"]).alias("_o1"), F.md5(F.col("v").cast("string")).alias("_o2"))
    work = work.withColumn("_bucket", R.hash_bucket(F.col("_o1"), 4))
    cut = R.split_hot_buckets(work, "_o1", "_o2").collect()
    assert len(cut) == len(rows)
    ordered = sorted(cut, key=lambda r: (r._o1, r._o2))
    assert [r._bucket for r in ordered] == sorted(r._bucket for r in cut)
    hot = [n for n in Counter(r._bucket for r in cut if r.k == 7).values()]
    assert len(hot) == 7 and max(hot) < 400
    assert all(r.k == 7 for r in cut if r._bucket.place % 2)
    split = D.stratified_split(df, "label", ["k"], 0.2, n_buckets=4)
    assert sorted(split.collect()) == sorted(plain.collect())


def test_expand_counts_chunks(spark):
    df = spark.createDataFrame([("x", 250), ("y", 3)], "k string, n long")
    out = D.expand_counts(df, "n", chunk=100)
    assert {r["k"]: r["c"] for r in out.groupBy("k").agg(F.count("*").alias("c")).collect()} == {"x": 250, "y": 3}


def test_exact_quantiles_match_definition(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 5, 7]], "x double")
    q = R.exact_quantiles(df, "x", [0.5, 0.25], names=["med", "p25"]).first()
    assert q["med"] == 3.5 and q["p25"] == 1.75


def test_roc_auc_exact_with_ties(spark):
    rows = [(1.0, 0.9), (1.0, 0.5), (0.0, 0.5), (0.0, 0.1)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert E.roc_auc(df).first()["roc_auc"] == pytest.approx((1 + 0.5 * 1 + 1 + 1) / 4)


def test_auc_matches_mllib_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from tabprep.sources import fixture
    p = fixture.preds(spark, SF001)
    ours = E.roc_auc(p).first()["roc_auc"]
    from pyspark.ml.functions import array_to_vector
    v = p.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(v)
    assert ours == pytest.approx(ev, abs=1e-3)


def test_metrics_match_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from tabprep.sources import fixture
    p = fixture.preds(spark, SF001)
    m = E.classification_metrics(p).first()
    for ours, name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert m[ours] == pytest.approx(ev.evaluate(p), abs=1e-9)


def test_contract_raises_on_missing(spark):
    r = raw(spark, SF001).drop("race")
    with pytest.raises(S.ContractError):
        S.select_contract(r)
    rep = S.schema_contract(r).first()
    assert rep["missing_columns"] == ["race"] and rep["extra_columns"] == ["copy_no", "record_id"]


def test_standardize_name():
    assert S.standardize_name("  Education-Num ") == "education_num"
    assert S.standardize_name("HOURS__PER  WEEK") == "hours_per_week"
    assert S.standardize_name("_a$b_") == "a_b"


def test_gates_raise(spark):
    cur = curated(spark, SF001)
    rep = Q.gate_report(cur)
    with pytest.raises(Q.GateError):
        Q.enforce(rep)  # the fixture has ages > 120 and hours > 168
    Q.enforce(rep, gates=["label_drift", "empty_result"])  # these pass


def test_dq_metrics_core_golden(spark):
    m = {r["metric_name"]: r["metric_value"] for r in
         Q.dq_metrics(raw(spark, SF001), curated(spark, SF001), "core", "x", "2024-01-01 00:00:00").collect()}
    assert m["raw_row_count"] == 1560 and m["curated_row_count"] == 1499
    assert m["raw_duplicate_count"] == 30 and m["invalid_token_count"] == 239
    assert m["timestamp_parse_failure_count"] == 172 and m["label_normalization_failure_count"] == 260
    assert m["label_drift_count"] == 0 and m["numeric_cast_failure_count"] == 15
    assert m["null_count__processed_at"] == 0
