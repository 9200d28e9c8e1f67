"""Registered queries: model fits, comparison, importance and scoring
(N01-N07, V07, V08 on fitted runs, V10).  Fitted models are not
SQL-expressible, so these carry no oracle (rows-only check); their companions
(split sizes, confusion totals, scored vocabulary) have one, and
tests/test_io_ml.py covers the fits."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import dedup as D
from tabprep.operators import schema as S
from tabprep.operators.partitioning import materialize
from tabprep.operators import prep as M
from tabprep.plans import leafwise as LW
from tabprep.plans import service as SV
from tabprep.plans import train as TR
from tabprep.plans.score import score
from tabprep.registry import CLEAN_SERVICE_CTE, CORE, CORE_CUR, KEEP, cleaned, curated, raw, register, with_ctes
from tabprep.sources import io

RAW_ONLY = with_ctes()

RUN_COLS = ["run_name", "model_type", "config_order", "is_best", *TR.COUNT_FIELDS, "train_accuracy", "test_accuracy", "test_precision",
            "test_recall", "test_f1_score", "test_roc_auc", "roc_auc_overfit_gap"]


def _runs(spark, sf, configs):
    res = TR.run_sweep(curated(spark, sf), configs)
    return res.runs.select(*RUN_COLS)


@register("model_sweep")
def q_model_sweep(spark, sf):
    """LR x2, decision tree x2, boosted trees (XGBoost if importable, else GBT)."""
    return _runs(spark, sf, TR.sweep_configs())


@register("lr_job")
def q_lr_job(spark, sf):
    return _runs(spark, sf, [TR.JOB_CONFIGS["lr"]])


@register("dt_job")
def q_dt_job(spark, sf):
    return _runs(spark, sf, [TR.JOB_CONFIGS["dt"]])


@register("xgb_job_fallback")
def q_xgb_job(spark, sf):
    res = TR.run_sweep(curated(spark, sf), [TR.JOB_CONFIGS["xgb"]], fallback=True)
    return res.runs.select(*RUN_COLS)


for _name in ("compact_lr", "compact_dt", "compact_gbt", "compact_xgb"):
    def _mk(n):
        def q(spark, sf):
            res = TR.run_sweep(curated(spark, sf), [TR.JOB_CONFIGS[n]], fallback=True)
            return res.runs.select(*RUN_COLS)
        return q
    register(f"{_name}_runs")(_mk(_name))


@register("feature_importance_dt")
def q_feature_importance(spark, sf):
    cfg = TR.SWEEP_CONFIGS[2]
    res = TR.run_sweep(curated(spark, sf), [cfg])
    return TR.feature_importance(spark, res.models[cfg.run_name], res.test_predictions[cfg.run_name])


@register("confusion_matrix_best")
def q_confusion_best(spark, sf):
    """The confusion table of the best run of the whole sweep."""
    res = TR.run_sweep(curated(spark, sf), TR.sweep_configs())
    best = res.runs.where("is_best").first()["run_name"]
    p = res.test_predictions[best]
    return p.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count")).orderBy("label", "prediction")


@register("batch_score")
def q_batch_score(spark, sf):
    cur = materialize(curated(spark, sf))  # fitted on and scored
    cfg = TR.SWEEP_CONFIGS[0]
    res = TR.run_sweep(cur, [cfg])
    from pyspark.ml import PipelineModel
    full = PipelineModel(stages=list(res.prep_model.stages) + [res.models[cfg.run_name]])
    records = cur.drop("income", "processed_at")
    return score(records, full, cfg.run_name)


@register("balanced_lr_runs")
def q_balanced_lr(spark, sf):
    """Balanced logistic regression on the service's engineered features."""
    return SV.train_service(raw(spark, sf), TR.JOB_CONFIGS["balanced_lr"], KEEP)[1]


@register("hist_gbt_runs")
def q_hist_gbt(spark, sf):
    """Boosted trees (220 rounds, rate 0.06) on the service's engineered features."""
    return SV.train_service(raw(spark, sf), TR.JOB_CONFIGS["hist_gbt"], KEEP)[1]


@register("service_score")
def q_service_score(spark, sf):
    """Every source row scored through the service's cleaning and preparation."""
    cfg = TR.ModelConfig("service_lr", "LogisticRegression", {"maxIter": 20}, weight_col="class_weight")
    model, _ = SV.train_service(raw(spark, sf), cfg, KEEP)
    return model.score(raw(spark, sf).drop("income"), keep=KEEP)


# --------------------------------------------- checkable companions of the fits
_KEY = " || '|' || ".join(f"coalesce({c}::VARCHAR, '')" if c not in ("event_time_std",) else
                          "coalesce(strftime(event_time_std, '%Y-%m-%d %H:%M:%S'), '')" for c in K.BUSINESS_KEY)
_SPLIT = (f"CASE WHEN ('0x' || substr(md5({_KEY}), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END")
_VALID = "FROM curated WHERE income IN ('<=80k', '>80k')"


@register("fit_split_counts", CORE_CUR + f"""
    SELECT split, income, count(*) AS rows FROM (SELECT {_SPLIT} AS split, income {_VALID}) GROUP BY ALL""")
def q_fit_split_counts(spark, sf):
    """Rows and labels on each side of the split that every fit uses, uncapped."""
    mf = TR.model_input(curated(spark, sf), TR.JOB_CONFIGS["compact_xgb"])
    return mf.groupBy("split", "income").agg(F.count(F.lit(1)).alias("rows"))


@register("compact_run_counts", CORE_CUR + f"""
    SELECT 'compact_dt' AS run_name, least(8000, count(*) FILTER (split = 'train'))::BIGINT AS fit_row_count,
        count(*) FILTER (split = 'train') AS train_row_count, count(*) FILTER (split = 'test') AS test_row_count
    FROM (SELECT {_SPLIT} AS split {_VALID})""")
def q_compact_run_counts(spark, sf):
    """The bound cuts fit rows only: the run is evaluated on every row."""
    return TR.run_sweep(curated(spark, sf), [TR.JOB_CONFIGS["compact_dt"]]).runs.select("run_name", *TR.COUNT_FIELDS)


@register("confusion_total_lr", CORE_CUR + f"""
    SELECT (income = '>80k')::INTEGER::DOUBLE AS label, count(*) AS rows
    FROM (SELECT {_SPLIT} AS split, income {_VALID}) WHERE split = 'test' GROUP BY 1""")
def q_confusion_total(spark, sf):
    """Every test row is predicted once: the confusion table's sums by label."""
    cfg = TR.JOB_CONFIGS["lr"]
    p = TR.run_sweep(curated(spark, sf), [cfg]).test_predictions[cfg.run_name]
    return p.groupBy("label", "prediction").count().groupBy("label").agg(F.sum("count").alias("rows"))


@register("random_split_total", CORE_CUR + f"SELECT count(*) AS rows, 0::BIGINT AS shared {_VALID}")
def q_random_split_total(spark, sf):
    """The native split loses and repeats nothing."""
    rows = S.model_frame(curated(spark, sf), keep=["event_time_std"]).withColumn("n", F.lit(1))
    numbered = materialize(rows.withColumn("id", F.monotonically_increasing_id()))
    train, test = D.random_split(numbered)
    sides = train.select("id", F.lit(1).alias("a"), F.lit(0).alias("b")).union(test.select("id", F.lit(0), F.lit(1)))
    each = sides.groupBy("id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return each.agg(F.sum(F.col("a") + F.col("b")).alias("rows"), F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("shared"))


@register("request_ingest", RAW_ONLY + """
    SELECT record_id, copy_no, spelling, age, education_level, education_num, hours_per_week, capital_gain, event_time AS event_time_std
    FROM raw, (VALUES ('kebab'), ('snake'), ('spaced'), ('upper')) AS s(spelling)""")
def q_request_ingest(spark, sf):
    """Requests as JSON text under four spellings of every key give the same rows."""
    fields = ["age", "education_level", "education_num", "hours_per_week", "capital_gain", "event_time"]
    spell = {"kebab": lambda n: n.replace("_", "-"), "snake": lambda n: n, "spaced": lambda n: f" {n.replace('_', ' ').title()} ",
             "upper": lambda n: n.upper()}

    def request(name: str, f):
        record = F.struct(*[F.col(c).alias(f(c)) for c in fields])
        text = F.to_json(F.struct(F.lit(name).alias("model"), F.array(record).alias("records")))
        return F.struct(F.lit(name).alias("spelling"), text.alias("j"))

    # the source is read and joined once for all spellings
    requests = raw(spark, sf).select(*KEEP, F.inline(F.array(*[request(name, f) for name, f in spell.items()])))
    parsed = requests.select(F.struct(*KEEP, "spelling").alias("model"), F.from_json("j", io.REQUEST_SCHEMA).alias("r")).select(
        "model", F.col("r.records").alias("records"))
    return io.explode_records(parsed).select("model.*", *fields[:-1], "event_time_std")


_SORT = ("('0x' || substr(md5(record_id || '|' || copy_no), 1, 15))::BIGINT, "
         "md5(record_id || '|' || copy_no || '|' || income)")
_SIDES = f"""sides AS (SELECT *, CASE WHEN rn < round(cnt * 0.8) THEN 'train' ELSE 'test' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY income ORDER BY {_SORT}) - 1 AS rn, count(*) OVER (PARTITION BY income) AS cnt
    FROM clean_s WHERE income IN ('<=80k', '>80k')))"""


@register("service_split_counts", with_ctes(CLEAN_SERVICE_CTE, _SIDES) + """
    SELECT split, income, count(*) AS rows FROM sides GROUP BY ALL""")
def q_service_split_counts(spark, sf):
    return SV.split_rows(raw(spark, sf), KEEP).groupBy("split", "income").agg(F.count(F.lit(1)).alias("rows"))


_FILLED = """filled AS (SELECT income, coalesce(age, (SELECT median(age) FROM sides WHERE split = 'train')) AS age,
    coalesce(hours_per_week, (SELECT median(hours_per_week) FROM sides WHERE split = 'train')) AS hours_per_week
    FROM sides WHERE split = 'train')"""


def _service_vectors(spark, sf):
    """The service's training side as label and feature vector, written once."""
    rows = SV.split_rows(raw(spark, sf), KEEP).where("split = 'train'")
    rows = rows.withColumn("label", (F.col(K.LABEL_COLUMN) == K.LABEL_HIGH).cast("double"))
    preparation = SV.fit_preparation(rows)
    return preparation, materialize(preparation.vectors(rows, ["label"]))


@register("leafwise_gbt_runs")
def q_leafwise_gbt(spark, sf):
    """Leaf-wise boosting with the source job's parameters, all 220 rounds."""
    return SV.train_service(raw(spark, sf), TR.JOB_CONFIGS["leafwise_gbt"], KEEP)[1]


@register("leafwise_histogram", with_ctes(CLEAN_SERVICE_CTE, _SIDES, _FILLED) + """
    SELECT feature, (dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1)::INTEGER AS bin, rows, positives FROM (
        SELECT feature, value, count(*) AS rows, count(*) FILTER (income = '>80k') AS positives FROM (
            SELECT 'age' AS feature, age::DOUBLE AS value, income FROM filled
            UNION ALL SELECT 'hours_per_week', hours_per_week::DOUBLE, income FROM filled) GROUP BY ALL)""")
def q_leafwise_histogram(spark, sf):
    """The first tree's histogram of two features, the left-out bins restored."""
    preparation, vectors = _service_vectors(spark, sf)
    names = preparation.columns()
    edges = LW.fit_edges(vectors)
    rows, layout = LW.binned(vectors, edges)
    common = layout.common
    found = LW.histograms(rows.withColumn("score", F.lit(0.0)), {}, [1], layout)
    # at score 0 a gradient is half a unit less the label
    sums = materialize(found.select("slot", "bin", "rows", (F.col("rows") / 2 - F.col("g") / LW.UNIT).cast("long").alias("positives")))
    slots = spark.createDataFrame([(f, names.index(f"{f}_scaled"), common[names.index(f"{f}_scaled")])
                                   for f in ("age", "hours_per_week")], "feature string, slot int, top int")
    listed = sums.join(slots, "slot")
    n, ones = sums.where("slot = -1").select("rows", "positives").first() or (0, 0)
    rest = slots.join(listed.groupBy("feature").agg(F.sum("rows").alias("r"), F.sum("positives").alias("q")), "feature", "left").select(
        "feature", F.col("top").alias("bin"), (F.lit(n) - F.coalesce("r", F.lit(0))).alias("rows"),
        (F.lit(ones) - F.coalesce("q", F.lit(0))).alias("positives"))
    return listed.select("feature", "bin", "rows", "positives").unionByName(rest)


@register("leafwise_trees", with_ctes(CLEAN_SERVICE_CTE, _SIDES) + """
    SELECT r.round::INTEGER AS round, (SELECT count(*) FROM sides WHERE split = 'train') AS rows, true AS capped, true AS falls
    FROM range(1, 4) AS r(round)""")
def q_leafwise_trees(spark, sf):
    """Each tree's leaves hold every row once, are at most 31, and the loss falls."""
    _, vectors = _service_vectors(spark, sf)
    p = LW.Params(**{**TR.JOB_CONFIGS["leafwise_gbt"].params, "rounds": 3})
    model = LW.fit(vectors, p)
    rows = [(i + 1, sum(t.rows.values()), 2 <= len(t.values) <= p.max_leaves, model.losses[i + 1] < model.losses[i])
            for i, t in enumerate(model.trees)]
    return spark.createDataFrame(rows, "round int, rows long, capped boolean, falls boolean")


@register("service_assembled", with_ctes(CLEAN_SERVICE_CTE, _SIDES, """filled AS (
    SELECT record_id, copy_no, split, coalesce(age, (SELECT median(age) FROM sides WHERE split = 'train')) AS age,
        coalesce(hours_per_week, (SELECT median(hours_per_week) FROM sides WHERE split = 'train')) AS hours,
        coalesce(capital_gain, 0.0) - coalesce(capital_loss, 0.0) AS net, sex FROM sides),
    m AS (SELECT avg(age) AS a, stddev_pop(age) AS sa, avg(hours) AS h, stddev_pop(hours) AS sh, avg(net) AS n, stddev_pop(net) AS sn
          FROM filled WHERE split = 'train'),
    known AS (SELECT DISTINCT sex FROM filled WHERE split = 'train')""") + """
    SELECT record_id, copy_no, split, round((age - a) / sa, 6) AS age_scaled, round((hours - h) / sh, 6) AS hours_per_week_scaled,
        round((net - n) / sn, 6) AS capital_net_scaled, (sex IN (SELECT sex FROM known))::INTEGER AS sex_on FROM filled, m""")
def q_service_assembled(spark, sf):
    """The assembled frame: medians, moments and vocabularies of the training side."""
    rows = SV.split_rows(raw(spark, sf), KEEP)
    preparation = SV.fit_preparation(rows.where("split = 'train'"))
    frame = preparation.apply(rows, [*KEEP, "split"])
    sexes = M.indicator_names("sex", preparation.vocabulary["sex"])
    return frame.select(*KEEP, "split", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in ("age", "hours_per_week", "capital_net")],
                        sum(F.col(c) for c in sexes).alias("sex_on"))


@register("service_score_total", with_ctes() + "SELECT count(*) AS rows, 0::BIGINT AS odd FROM raw")
def q_service_score_total(spark, sf):
    """Every record gets one prediction of the vocabulary and a probability."""
    out = q_service_score(spark, sf)
    good = F.col("prediction").isin(*K.LABELS) & F.col("probability_gt_80k").between(0, 1)
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(good, F.lit(False))).alias("odd"))


@register("impute_approx_median_error", CORE + """
    SELECT 'age' AS column_name, count(age) AS present, quantile_disc(age, 0.5)::DOUBLE AS lower_median FROM clean""")
def q_impute_approx_error(spark, sf):
    """The approximate imputer's value is the lower median to within its accuracy
    (exact at this accuracy while the distinct values are fewer)."""
    rows = cleaned(spark, sf)
    fitted = M.imputer_stage(["age"]).setRelativeError(0.0).fit(rows.select(F.col("age").cast("double").alias("age")))
    value = fitted.surrogateDF.first()["age"]
    return rows.agg(F.lit("age").alias("column_name"), F.count("age").alias("present"), F.lit(float(value)).alias("lower_median"))


@register("onehot_keep_array", CORE + """
    SELECT record_id, copy_no, sex, rank AS slot FROM clean LEFT JOIN (
        SELECT sex, (row_number() OVER (ORDER BY count(*) DESC, sex) - 1)::DOUBLE AS rank FROM clean WHERE sex IS NOT NULL GROUP BY sex) USING (sex)
    WHERE sex IS NOT NULL""")
def q_onehot_keep_array(spark, sf):
    """The keep encoder's only set slot of every known category."""
    rows = cleaned(spark, sf).select(*KEEP, "sex").where("sex IS NOT NULL")
    fitted = M.build_pipeline(M.category_stages(["sex"]) + [M.onehot_stage(["sex"])]).fit(rows)
    slots = vector_to_array("sex_ohe")
    return fitted.transform(rows).select(*KEEP, "sex", (F.array_position(slots, F.lit(1.0)) - 1).cast("double").alias("slot"))
