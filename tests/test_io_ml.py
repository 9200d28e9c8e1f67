"""Sources/sinks, publish read-back, batch + micro-batch scoring, model fits."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabprep import constants as K
from tabprep.operators import schema as S
from tabprep.plans import train as TR
from tabprep.plans.clean import clean
from tabprep.plans.score import score
from tabprep.registry import curated, raw
from tabprep.sources import io

# One scoring request in the record-batch format.
SAMPLE = {
    "model": "lr_baseline",
    "records": [
        {"age": 39, "workclass": "State-gov", "education": "Bachelors", "education-num": 13,
         "marital-status": "Never-married", "occupation": "Adm-clerical", "relationship": "Not-in-family",
         "race": "White", "sex": "Male", "capital-gain": 2174, "capital-loss": 0, "hours-per-week": 40,
         "native-country": "United-States", "random_flag": "y", "source_system": "web",
         "event_time_std": "2024-03-05 10:20:30"},
        {"age": "ERROR_AGE", "workclass": None, "education": " ", "education-num": "9",
         "marital-status": "Divorced", "occupation": "Sales", "relationship": "Wife", "race": "?", "sex": " Female",
         "capital-gain": "$1k", "capital-loss": "5%", "hours-per-week": "200", "native-country": "Mexico",
         "random_flag": None, "source_system": "crm", "event_time_std": "1700000000"},
    ],
}


def test_csv_roundtrip_all_strings(spark, tmp_dir):
    r = S.select_contract(raw(spark, SF001))
    path = os.path.join(tmp_dir, "raw_csv")
    r.write.option("header", "true").csv(path)
    back = io.read_raw_csv(spark, path)
    assert back.columns == K.CONTRACT_COLUMNS
    assert all(t == "string" for _, t in back.dtypes)
    assert back.count() == r.count()
    # blanks come back as NULL (PERMISSIVE reader), which the cleaners treat like ''
    a = clean(back, "core").agg(F.count_if(F.col("age").isNull())).first()[0]
    b = clean(r, "core").agg(F.count_if(F.col("age").isNull())).first()[0]
    assert a == b
    kb = io.read_raw_csv(spark, path, keep_blank=True)
    assert kb.where(F.col("workclass").isNull()).count() == 0


def test_messy_header_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "messy.csv")
    with open(path, "w") as f:
        f.write(" Age ,Education-Num,extra col\n39,13,x\n,9\n")
    df = S.standardize_columns(io.read_raw_csv(spark, path))
    assert df.columns == ["age", "education_num", "extra_col"]
    rows = df.orderBy("education_num").collect()
    assert rows[0]["age"] == "39" and rows[1]["extra_col"] is None
    assert dict(io.read_inferred_csv(spark, path).dtypes)[" Age "] == "int"


def test_json_batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "req.json")
    with open(path, "w") as f:
        json.dump(SAMPLE, f)
    df = io.read_json_batch(spark, path)
    assert df.count() == 2
    assert {"education_level", "education_num", "hours_per_week", "event_time_std"} <= set(df.columns)
    assert df.orderBy("source_system").first()["age"] == "ERROR_AGE"


def test_publish_and_validate(spark, tmp_dir):
    cur = curated(spark, SF001)
    fmt = io.publish(cur, "tabprep_test.curated")
    assert fmt in ("delta", "parquet")
    assert io.validate_publish(spark, "tabprep_test.curated", cur) == 1499
    io.publish(cur.limit(10), "tabprep_test.curated")  # idempotent overwrite
    assert spark.table("tabprep_test.curated").count() == 10
    with pytest.raises(io.PublishError):
        io.validate_publish(spark, "tabprep_test.curated", cur)


@pytest.fixture(scope="module")
def lr_result(spark):
    return TR.run_sweep(curated(spark, SF001), [TR.SWEEP_CONFIGS[0]])


def test_sweep_runs_table(spark, lr_result):
    runs = lr_result.runs.collect()
    assert len(runs) == 1 and runs[0]["is_best"]
    assert 0 <= runs[0]["test_roc_auc"] <= 1
    valid = S.model_frame(curated(spark, SF001)).count()
    assert lr_result.train_count + lr_result.test_count == valid


def test_feature_importance_names(spark, lr_result):
    imp = TR.feature_importance(spark, lr_result.models["lr_baseline"], lr_result.test_predictions["lr_baseline"])
    names = [r["feature"] for r in imp.collect()]
    assert len(names) == len(lr_result.models["lr_baseline"].coefficients) > 30  # every slot, not a top list
    assert not any(n.startswith("f") and n[1:].isdigit() for n in names)
    assert [r["importance"] for r in imp.collect()] == sorted((r["importance"] for r in imp.collect()), reverse=True)


def test_batch_score_and_save_load(spark, tmp_dir, lr_result):
    from pyspark.ml import PipelineModel
    full = PipelineModel(stages=list(lr_result.prep_model.stages) + [lr_result.models["lr_baseline"]])
    path = os.path.join(tmp_dir, "model")
    TR.save_model(spark, lr_result.prep_model, lr_result.models["lr_baseline"], path, {"features": K.NUMERIC_FEATURES})
    loaded, meta = TR.load_model(spark, path)
    assert meta["features"] == K.NUMERIC_FEATURES
    req = os.path.join(tmp_dir, "req.json")
    with open(req, "w") as f:
        json.dump(SAMPLE, f)
    out = score(io.read_json_batch(spark, req), loaded, "lr_baseline").collect()
    assert len(out) == 2
    assert all(r["prediction"] in K.LABELS and 0 <= r["probability_gt_80k"] <= 1 for r in out)
    cur = curated(spark, SF001)
    assert score(cur.drop("income"), full, "lr").count() == cur.count()


def test_stream_scoring(spark, tmp_dir, lr_result):
    from pyspark.ml import PipelineModel
    from tabprep.streaming.score_stream import score_stream
    full = PipelineModel(stages=list(lr_result.prep_model.stages) + [lr_result.models["lr_baseline"]])
    in_dir, out_dir, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(in_dir)
    for i in range(3):
        with open(os.path.join(in_dir, f"req{i}.json"), "w") as f:
            json.dump(SAMPLE, f)
    q = score_stream(spark, in_dir, out_dir, ck, full, "lr_baseline")
    q.awaitTermination(120)
    assert spark.read.parquet(out_dir).count() == 6
    # restart: already-scored files are not scored again
    with open(os.path.join(in_dir, "req9.json"), "w") as f:
        json.dump(SAMPLE, f)
    q = score_stream(spark, in_dir, out_dir, ck, full, "lr_baseline")
    q.awaitTermination(120)
    assert spark.read.parquet(out_dir).count() == 8


def test_run_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runs")
    run = {"run_id": "r1", "run_name": "x", **{k: 0.5 for k in TR.RUN_FIELDS[3:]}}
    TR.log_run(spark, path, run, params={"maxIter": 30})
    TR.log_run(spark, path, {**run, "run_id": "r2"})
    df = spark.read.parquet(path)
    assert df.select("run_id").distinct().count() == 2
    assert df.where("kind = 'param'").count() == 1


def test_xgboost_hard_fail_without_fallback():
    if TR.XGBOOST_AVAILABLE:
        pytest.skip("xgboost installed")
    with pytest.raises(ImportError):
        TR.make_estimator(TR.JOB_CONFIGS["xgb"])
    assert type(TR.make_estimator(TR.JOB_CONFIGS["xgb"], fallback=True)).__name__ == "GBTClassifier"


@pytest.mark.parametrize("spell", [lambda n: n.replace("_", "-"), lambda n: n, lambda n: f" {n.replace('_', ' ')} ", str.upper])
def test_json_spellings(spark, tmp_dir, spell):
    record = {"age": 41, "education_num": "13", "hours_per_week": 40, "education_level": "Masters", "event_time": "2024-01-02",
              "capital_gain": 7.5}
    path = os.path.join(tmp_dir, "req.json")
    with open(path, "w") as f:
        json.dump({"model": "m", "records": [{spell(k): v for k, v in record.items()}, {}]}, f)
    rows = io.read_json_batch(spark, path).collect()
    got = next(r for r in rows if r["age"])
    assert (got["age"], got["education_num"], got["hours_per_week"], got["education_level"], got["event_time_std"], got["capital_gain"]) == (
        "41", "13", "40", "Masters", "2024-01-02", "7.5")
    assert len(rows) == 2


def test_publish_report(spark):
    cur = curated(spark, SF001).limit(5).select("age", "sex")
    io.publish(cur.select("sex", "age"), "tabprep_test.turned")
    checks = {r.check_name: r.passed for r in io.publish_report(spark, "tabprep_test.turned", cur).collect()}
    assert checks == {"row_count": True, "column_order": False}
    assert io.read_table(spark, "tabprep_test.turned").count() == 5
    assert [tuple(r) for r in S.column_metadata(spark, cur).collect()] == [("age", "int", True), ("sex", "string", True)]


def test_auc_edges(spark):
    from tabprep.operators import evaluate as E
    one = spark.createDataFrame([(1.0, 0.2, 1.0, "a"), (1.0, 0.4, 1.0, "a"), (1.0, 0.9, 1.0, "b"), (0.0, 0.1, 0.0, "b")],
                                "label double, score double, prediction double, g string")
    got = {r["g"]: r for r in E.evaluate(one, groups=["g"]).collect()}
    assert got["a"]["roc_auc"] is None and got["a"]["accuracy"] == 1.0 and got["b"]["roc_auc"] == 1.0
    assert E.overfit_gap(one.withColumn("split", F.lit("train"))).first()["roc_auc_overfit_gap"] is None
    many = spark.createDataFrame([(1.0, 0.9, 4_000_000_000), (0.0, 0.1, 4_000_000_000)], "label double, score double, _n long")
    assert E._auc(many, "label", "score", [], None).first()[0] == 1.0


def test_onehot_names_and_cardinality(spark):
    from tabprep.operators import prep as M
    df = spark.createDataFrame([("own-child",), ("own child",), ("x",), (None,)], "v string")
    out = M.onehot_ignore(df, ["v"])
    assert len(set(out.columns)) == 4 and {"v__own_child", "v__own_child__2"} <= set(out.columns)
    assert all(sum(r) == 1 for r in out.collect())
    with pytest.raises(M.CardinalityError):
        M.fit_vocabulary(df, ["v"], max_categories=2)


def test_sweep_honours_each_config(spark):
    res = TR.run_sweep(curated(spark, SF001), [TR.JOB_CONFIGS["dt"], TR.JOB_CONFIGS["compact_dt"],
                                               TR.ModelConfig("small", "LogisticRegression", {"maxIter": 2}, fit_row_limit=200),
                                               TR.JOB_CONFIGS["compact_xgb"]])
    runs = {r["run_name"]: r for r in res.runs.collect()}
    sizes = {n: m.numFeatures for n, m in res.models.items()}
    assert sizes["dt_job"] > sizes["compact_dt"] == 12
    assert runs["small"]["fit_row_count"] == 200 and runs["dt_job"]["fit_row_count"] == runs["dt_job"]["train_row_count"]
    assert len({r["test_row_count"] for r in runs.values()}) == 1
    fallback = runs["compact_xgb_GBTClassifier_fallback"] if not TR.XGBOOST_AVAILABLE else runs["compact_xgb"]
    assert fallback["model_type"] == type(res.models[fallback["run_name"]]).__name__.replace("ClassificationModel", "Classifier")


def test_balanced_fit_and_run_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    cfg = TR.ModelConfig("balanced", "LogisticRegression", {"maxIter": 5}, weight_col="class_weight")
    TR.run_sweep(curated(spark, SF001), [cfg], log_table=path, source="fixture")
    keys = {r["key"] for r in spark.read.parquet(path).collect()}
    assert {"fit_row_limit", "encoding", "source_table", "test_roc_auc", "train_accuracy"} <= keys


def test_service_model_dialect(spark):
    from tabprep.plans import service as SV
    from tabprep.registry import KEEP, raw
    cfg = TR.ModelConfig("service_lr", "LogisticRegression", {"maxIter": 5}, weight_col="class_weight")
    model, metrics = SV.train_service(raw(spark, SF001), cfg, KEEP)
    assert {r["split"] for r in metrics.collect()} == {"train", "test"}
    records = spark.createDataFrame([("a", "ERROR_39", "?", "Never-Seen"), ("b", "39", None, "never-seen"), ("c", None, "Private", None)],
                                    "id string, age string, workclass string, occupation string")
    rows = {r["id"]: r for r in model.score(records, keep=["id"]).collect()}
    assert len(rows) == 3 and rows["a"]["probability_gt_80k"] == rows["b"]["probability_gt_80k"]  # ERROR_39 is 39, ? is missing
    assert all(r["prediction"] in K.LABELS and 0 <= r["probability_gt_80k"] <= 1 for r in rows.values())
