"""Registered queries: evaluation on the scored fixture and on fixed-weight
linear scorers over the feature frame (V01-V06, V08, V11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import evaluate as E
from tabprep.operators.features import build_features
from tabprep.plans import train as TR
from tabprep.registry import KEEP, cleaned, register
from tabprep.session import apply_conf, ensure_checkpoint_dir
from tabprep.sources import fixture

PREDS = "WITH " + fixture.duckdb_ctes("preds") + "\n"


def _preds(spark, sf):
    apply_conf(spark)
    return fixture.preds(spark, sf, spread_scan=True)


def _metrics_sql(src: str, group: str | None, digits: int | None = None) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    on = f"USING ({group})" if group else "ON true"

    def r(x):
        return f"round({x}, {digits})" if digits is not None else x
    return f"""conf AS (SELECT {g}label, prediction, count(*) AS n FROM {src} GROUP BY {g}label, prediction),
pc AS (SELECT {g}cls, sum(n_true) AS n_true, sum(n_pred) AS n_pred, sum(tp) AS tp FROM (
  SELECT {g}label AS cls, n AS n_true, 0 AS n_pred, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM conf
  UNION ALL SELECT {g}prediction AS cls, 0, n, 0 FROM conf) GROUP BY {g}cls),
m AS (SELECT {g}
  sum(tp) / sum(n_true) AS accuracy,
  sum(n_true * CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END) / sum(n_true) AS weighted_precision,
  sum(n_true * CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END) / sum(n_true) AS weighted_recall,
  sum(n_true * CASE WHEN (CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END) + (CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END) > 0
    THEN 2 * (CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END) * (CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END)
       / ((CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END) + (CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END))
    ELSE 0.0 END) / sum(n_true) AS f1
  FROM pc {gb}),
s AS (SELECT {g}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM {src} GROUP BY {g}score),
a AS (SELECT {g}sum(pos * (nb + neg / 2.0)) / (max(pt) * max(nt)) AS roc_auc FROM (
  SELECT {g}pos, neg, COALESCE(sum(neg) OVER ({'PARTITION BY ' + group if group else ''} ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
    sum(pos) OVER ({'PARTITION BY ' + group if group else ''}) AS pt, sum(neg) OVER ({'PARTITION BY ' + group if group else ''}) AS nt FROM s) {gb})
SELECT {g}{r('accuracy')} AS accuracy, {r('weighted_precision')} AS weighted_precision,
  {r('weighted_recall')} AS weighted_recall, {r('f1')} AS f1, {r('roc_auc')} AS roc_auc FROM m JOIN a {on}"""


@register("evaluate_preds", PREDS[:-1] + ",\n" + _metrics_sql("preds", None, 6))
def q_evaluate_preds(spark, sf):
    return E.evaluate(_preds(spark, sf), digits=6)


@register("evaluate_preds_by_split", PREDS[:-1] + ",\n" + _metrics_sql("preds", "split", 6))
def q_evaluate_preds_by_split(spark, sf):
    return E.evaluate(_preds(spark, sf), groups=["split"], digits=6)


@register("confusion_matrix", PREDS + "SELECT label, prediction, count(*) AS count FROM preds GROUP BY 1, 2 ORDER BY 1, 2")
def q_confusion_matrix(spark, sf):
    return E.confusion_matrix(_preds(spark, sf))


@register("overfit_gap", PREDS[:-1] + ",\n" + _metrics_sql("preds", "split", None).split("\nSELECT")[0] + """
SELECT round(max(roc_auc) FILTER (WHERE split = 'train'), 6) AS train_roc_auc,
       round(max(roc_auc) FILTER (WHERE split = 'test'), 6) AS test_roc_auc,
       round(max(roc_auc) FILTER (WHERE split = 'train') - max(roc_auc) FILTER (WHERE split = 'test'), 6) AS roc_auc_overfit_gap
FROM a""")
def q_overfit_gap(spark, sf):
    g = E.overfit_gap(_preds(spark, sf))
    return g.select(*[F.round(c, 6).alias(c) for c in g.columns])


# --------------------------------------------------------- V11 + V08 on data
# Three linear scorers over engineered features (name, bias, weights).
LINEAR_CONFIGS = [
    ("linear_capital", -1.0, {"capital_net": 0.0005, "has_capital_gain": 0.8}),
    ("linear_education", -2.0, {"education_num": 0.25, "hours_per_week": 0.01}),
    ("linear_mixed", -3.0, {"age": 0.03, "education_num": 0.15, "capital_total": 0.0002, "hours_x_education": 0.001}),
]


def _linear_preds(spark, sf):
    from tabprep.operators.dedup import hash_split
    feats = build_features(cleaned(spark, sf, "service"), keep=KEEP + ["income"])
    feats = feats.where(F.col("income").isin(*K.LABELS))
    feats = hash_split(feats, KEEP)
    rows = []
    for i, (name, bias, w) in enumerate(LINEAR_CONFIGS):
        s = F.round(E.linear_score(w, bias), 9)
        rows.append(feats.select(F.lit(name).alias("run_name"), F.lit(i).alias("config_order"), "split",
                                 F.when(F.col("income") == K.LABEL_HIGH, 1.0).otherwise(0.0).alias("label"),
                                 s.alias("score"),
                                 F.when(s >= 0.5, 1.0).otherwise(0.0).alias("prediction")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _linear_sql() -> str:
    from tabprep.queries.features import _features_sql
    from tabprep.registry import SERVICE  # noqa: F401
    feats_body = _features_sql().split("SELECT record_id, copy_no, ", 1)
    feats_cte = feats_body[0].rstrip("\n") + ",\nfeats AS (SELECT record_id, copy_no, income, " + feats_body[1] + \
        " WHERE income IN ('<=80k', '>80k'))"
    hb = ("CAST(('0x' || substr(md5(CAST(record_id AS VARCHAR) || '|' || CAST(copy_no AS VARCHAR)), 1, 8)) "
          "AS BIGINT) % 100")
    parts = []
    for i, (name, bias, w) in enumerate(LINEAR_CONFIGS):
        z = " + ".join([f"{float(bias)!r}"] + [f"COALESCE(CAST({c} AS DOUBLE), 0.0) * {float(v)!r}" for c, v in w.items()])
        s = f"round(1.0 / (1.0 + exp(-({z}))), 9)"
        parts.append(f"SELECT '{name}' AS run_name, {i} AS config_order, CASE WHEN {hb} < 80 THEN 'train' ELSE 'test' END "
                     f"AS split, CASE WHEN income = '>80k' THEN 1.0 ELSE 0.0 END AS label, {s} AS score, "
                     f"CASE WHEN {s} >= 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM feats")
    return feats_cte + ",\nlp AS (" + " UNION ALL ".join(parts) + ")"


@register("linear_score_metrics", _linear_sql() + ",\n" + _metrics_sql("lp", "run_name, split", 6)
          .replace("USING (run_name, split)", "USING (run_name, split)"))
def q_linear_score_metrics(spark, sf):
    return E.evaluate(_linear_preds(spark, sf), groups=["run_name", "split"], digits=6)


_LEADERBOARD = (_linear_sql() + ",\n" + _metrics_sql("lp", "run_name, config_order, split", 6).rsplit("\nSELECT", 1)[0]
          + """,
ev AS (SELECT run_name, config_order, split, round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS precision,
  round(weighted_recall, 6) AS recall, round(f1, 6) AS f1_score, round(roc_auc, 6) AS roc_auc FROM m JOIN a USING (run_name, config_order, split)),
runs AS (SELECT t.run_name, t.config_order, tr.accuracy AS train_accuracy, t.accuracy AS test_accuracy,
  t.precision AS test_precision, t.recall AS test_recall, t.f1_score AS test_f1_score, t.roc_auc AS test_roc_auc,
  round(tr.roc_auc - t.roc_auc, 6) AS roc_auc_overfit_gap
  FROM ev t JOIN ev tr ON t.run_name = tr.run_name AND t.split = 'test' AND tr.split = 'train')
SELECT *, row_number() OVER (ORDER BY test_roc_auc DESC, config_order) = 1 AS is_best FROM runs""")


@register("leaderboard", _LEADERBOARD)
def q_leaderboard(spark, sf):
    return E.leaderboard(_linear_runs(spark, sf))


def _linear_runs(spark, sf):
    ev = E.evaluate(_linear_preds(spark, sf), groups=["run_name", "config_order", "split"], digits=6)
    return ev.groupBy("run_name", "config_order").agg(
        F.max(F.when(F.col("split") == "train", F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("test_accuracy"),
        F.max(F.when(F.col("split") == "test", F.col("weighted_precision"))).alias("test_precision"),
        F.max(F.when(F.col("split") == "test", F.col("weighted_recall"))).alias("test_recall"),
        F.max(F.when(F.col("split") == "test", F.col("f1"))).alias("test_f1_score"),
        F.max(F.when(F.col("split") == "test", F.col("roc_auc"))).alias("test_roc_auc"),
        F.round(F.max(F.when(F.col("split") == "train", F.col("roc_auc")))
                - F.max(F.when(F.col("split") == "test", F.col("roc_auc"))), 6).alias("roc_auc_overfit_gap"),
    )


@register("logged_leaderboard", "SELECT * EXCLUDE (config_order) FROM (" + _LEADERBOARD + ")")
def q_logged_leaderboard(spark, sf):
    """The runs are logged as long rows, each by a job of its own, and
    compared from the log alone."""
    log = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabprep-{uuid.uuid4().hex}"
    for run in _linear_runs(spark, sf).orderBy("config_order").collect():  # one row per configuration
        TR.log_run(spark, log, {"run_id": f"{run['config_order']}-{uuid.uuid4().hex}", **run.asDict()})
    return TR.logged_leaderboard(spark, log).select("run_name", *TR.RUN_FIELDS[3:], "is_best")
