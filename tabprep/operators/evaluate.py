"""Classifier evaluation without ten evaluator passes.

* accuracy / weighted precision / weighted recall / weighted F1 come from one
  confusion-matrix aggregate (k x k rows) and arithmetic over it;
* ROC-AUC is exact (tie-averaged rank form): predictions are grouped by score
  first, then negatives-before counts come from the distributed prefix sum in
  :mod:`tabprep.operators.rank` -- never a single-task global window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators import rank as R
from tabprep.operators.partitioning import materialize


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     groups=()) -> DataFrame:
    """(label, prediction, count), ordered."""
    return (pred.groupBy(*groups, label, prediction).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(*groups, label, prediction))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                           groups=(), digits: int | None = None) -> DataFrame:
    """Accuracy, weighted precision/recall/F1 per group.

    Weights are the true-class shares (the rule of the multiclass evaluator);
    a class's precision is 0 when it is never predicted."""
    groups = list(groups)
    out = _metrics(pred.groupBy(*groups, label, prediction).agg(F.count(F.lit(1)).alias("n")), label, prediction, groups)
    if digits is not None:
        out = out.select(*groups, *[F.round(c, digits).alias(c) for c in
                                    ("accuracy", "weighted_precision", "weighted_recall", "f1")])
    return out


def _metrics(conf: DataFrame, label: str, prediction: str, groups: list) -> DataFrame:
    """Metrics of a confusion table ``(groups, label, prediction, n)``."""
    # per class c: n_c (true), p_c (predicted), tp_c -- one row per (group, class)
    per_class = conf.select(*groups, F.inline(F.array(
        F.struct(F.col(label).cast("double").alias("cls"), F.col("n").alias("n_true"), F.lit(0).cast("long").alias("n_pred"),
                 F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).cast("long").alias("tp")),
        F.struct(F.col(prediction).cast("double").alias("cls"), F.lit(0).cast("long").alias("n_true"),
                 F.col("n").alias("n_pred"), F.lit(0).cast("long").alias("tp")),
    ))).groupBy(*groups, "cls").agg(F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"),
                                    F.sum("tp").alias("tp"))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return per_class.groupBy(*groups).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        (F.sum(F.col("n_true") * prec) / F.sum("n_true")).alias("weighted_precision"),
        (F.sum(F.col("n_true") * rec) / F.sum("n_true")).alias("weighted_recall"),
        (F.sum(F.col("n_true") * f1) / F.sum("n_true")).alias("f1"),
    )


def by_score(pred: DataFrame, cols) -> DataFrame:
    """Predictions collapsed to their distinct ``cols`` with a count ``_n``,
    written once: every metric is read from this small table."""
    return materialize(pred.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score", groups=(),
            n_buckets: int | None = None) -> DataFrame:
    """Exact tie-averaged ROC-AUC per group,
    ``sum_s pos_s * (neg_before_s + neg_s / 2) / (P * N)``; NULL for a group
    that holds one class only."""
    return _auc(by_score(pred, [*groups, score, label]), label, score, list(groups), n_buckets)


def _auc(counted: DataFrame, label: str, score: str, groups: list, n_buckets: int | None) -> DataFrame:
    scores = counted.groupBy(*groups, score).agg(
        F.sum(F.when(F.col(label) == 1, F.col("_n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(F.col("_n"))).alias("neg"))
    scores = R.with_quantile_bucket(scores, score, n_buckets or R.default_buckets(counted))
    pref = R.exclusive_prefix(scores, [score], ["pos", "neg"], groups)
    # products of counts leave the range of a long at a few billion rows
    real = lambda c: F.col(c).cast("double")
    pairs = F.max(real("pos_total")) * F.max(real("neg_total"))
    return pref.groupBy(*groups).agg(
        F.try_divide(F.sum(real("pos") * (real("neg_before") + real("neg") / 2.0)), pairs).alias("roc_auc"))


def overfit_gap(pred: DataFrame, label: str = "label", score: str = "score", split: str = "split",
                train: str = "train", test: str = "test") -> DataFrame:
    """AUC(train) - AUC(test) by conditional aggregation over the split column."""
    auc = roc_auc(pred, label, score, groups=[split])
    return auc.agg(
        F.max(F.when(F.col(split) == train, F.col("roc_auc"))).alias("train_roc_auc"),
        F.max(F.when(F.col(split) == test, F.col("roc_auc"))).alias("test_roc_auc"),
    ).withColumn("roc_auc_overfit_gap", F.col("train_roc_auc") - F.col("test_roc_auc"))


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score",
             groups=(), digits: int | None = None) -> DataFrame:
    """All five metrics per group from one pass over the predictions: they are
    collapsed by (groups, score, prediction, label) first.  The two aggregates
    (one row per group each) are unioned and folded per group, so no join -- and
    never a cartesian product -- is planned."""
    groups = list(groups)
    names = ["accuracy", "weighted_precision", "weighted_recall", "f1", "roc_auc"]
    counted = by_score(pred, [*groups, score, prediction, label])
    m = _metrics(counted.groupBy(*groups, label, prediction).agg(F.sum("_n").alias("n")), label, prediction, groups)
    a = _auc(counted, label, score, groups, None)
    both = m.unionByName(a, allowMissingColumns=True)
    folded = (both.groupBy(*groups) if groups else both).agg(*[F.max(c).alias(c) for c in names])
    if digits is not None:
        folded = folded.select(*groups, *[F.round(c, digits).alias(c) for c in names])
    return folded


# ------------------------------------------------------------------------ V11
def linear_score(weights: dict, bias: float = 0.0) -> Column:
    """Logistic score with fixed weights: ``1 / (1 + exp(-(b + sum w*x)))``;
    NULL inputs count as 0."""
    z = reduce(lambda a, b: a + b,
               [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()],
               F.lit(float(bias)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# ------------------------------------------------------------------------ V08
def leaderboard(runs: DataFrame, metric: str = "test_roc_auc", order_col: str = "config_order") -> DataFrame:
    """Runs sorted by ``metric`` descending; ``is_best`` marks the first strict
    maximum in config order.  ``runs`` has one row per configuration (a
    bounded table), so a global window over it is cheap."""
    from pyspark.sql import Window
    w = Window.orderBy(F.desc(metric), F.col(order_col))
    return runs.withColumn("is_best", F.row_number().over(w) == 1).orderBy(F.desc(metric), order_col)
