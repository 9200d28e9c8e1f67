"""Whole boosted fits and sweeps, and the passes that make them affordable."""

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.ml import classification
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import partitioning as P
from tabprep.plans import boosting as B
from tabprep.plans import gbt
from tabprep.plans import leafwise as LW
from tabprep.plans import service as SV
from tabprep.plans import train as TR
from tabprep.queries import ml as ML


def curated_rows(spark, n=600):
    """Rows whose label no line tells apart: the middle ages."""
    rng, rows = random.Random(5), []
    for i in range(n):
        age, hours = rng.randrange(20, 70), float(rng.randrange(10, 70))
        value = {"age": age, "hours_per_week": hours, "education_num": float(rng.randrange(1, 16)), "capital_gain": 0.0, "capital_loss": 0.0,
                 "income": K.LABELS[1] if 32 < age < 57 else K.LABELS[0],
                 "event_time_std": datetime(2024, 1, 1) + timedelta(hours=i)}
        rows.append(tuple(value.get(c, f"{c}{rng.randrange(3)}") for c in K.CURATED_COLUMNS))
    kinds = {"age": "int", "event_time_std": "timestamp", **{c: "double" for c in K.NUMERIC_CLEAN_COLUMNS}}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in K.CURATED_COLUMNS))


def test_best_is_chosen_among_all_runs(spark, monkeypatch):
    """No logistic regression tells these labels apart; a tree of the sweep does."""
    monkeypatch.setattr(ML, "curated", lambda spark, sf: curated_rows(spark))
    monkeypatch.setattr(TR, "BOOST_FALLBACK", TR.ModelConfig("gbt_fallback_for_xgboost", "GBTClassifier", {"maxIter": 2}))
    found = {(r["label"], r["prediction"]): r["count"] for r in ML.q_confusion_best(spark, None).collect()}
    right = found.get((0.0, 0.0), 0) + found.get((1.0, 1.0), 0)
    assert right > 0.85 * sum(found.values())


def test_leafwise_runs_fit_all_rounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ML, "raw", lambda spark, sf: None)
    monkeypatch.setattr(SV, "train_service", lambda raw, cfg, keys: (None, seen.append(cfg)))
    ML.q_leafwise_gbt(spark, None)
    assert seen[0].params == TR.JOB_CONFIGS["leafwise_gbt"].params and seen[0].params["rounds"] == 220


def vectors(spark, rows):
    return spark.createDataFrame(rows, "label double, x array<double>").withColumn("features", array_to_vector("x"))


def mixed(n=900):
    """Two numbers, one of them with NaN, and two one-hot groups."""
    rng, rows = random.Random(9), []
    for i in range(n):
        a, b = rng.randrange(5), rng.randrange(3)
        x = [float(rng.randrange(40)), float("nan") if i % 50 == 0 else rng.gauss(0, 1)]
        x += [float(a == k) for k in range(5)] + [float(b == k) for k in range(3)]
        rows.append((float((x[0] > 20) ^ (a == 2) or rng.random() < 0.1), x))
    return rows


def test_one_hot_slots_share_a_column(spark):
    df = vectors(spark, mixed())
    edges = LW.fit_edges(df)
    rows, layout = LW.binned(df, edges)
    found = B.bundled(rows, len(edges), layout.kind(), layout.common, layout.sizes)
    assert [2, 3, 4, 5, 6] in found and [7, 8, 9] in found
    packing = B.Packing(layout.sizes, layout.common, found)
    assert len(packing.columns) < len(edges)
    bins = B.unpacked(rows.select("_bins").toArrow()["_bins"].combine_chunks(), len(edges), layout.kind())
    columns = packing.pack(bins)
    for slot, size in enumerate(layout.sizes):
        for cut in range(size - 1):
            column, right = packing.right(slot, cut)
            assert (right[columns[column]] == (bins[:, slot] > cut)).all()


def test_model_is_the_same_in_the_cluster_and_beyond_64_leaves(spark, monkeypatch):
    df = vectors(spark, mixed()).repartition(4)
    p = LW.Params(rounds=5, max_leaves=70, least_rows=2)
    here = LW.fit(df, p)
    assert max(len(t.values) for t in here.trees) > 64
    monkeypatch.setattr(B, "FEW_ROWS", 0)
    monkeypatch.setattr(B, "DIRECT", 2)
    monkeypatch.setattr(B, "KEPT_ROUNDS", 2)
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    there = LW.fit(df, p)
    assert there.trees == here.trees and np.allclose(there.losses, here.losses, rtol=1e-12)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held


def test_masks_find_the_leaf_that_the_walk_finds(spark):
    df = vectors(spark, mixed())
    model = LW.fit(df, LW.Params(rounds=3, max_leaves=31, least_rows=3))
    bins = LW.bin_matrix(df.toPandas()["x"].map(np.array), model.edges)
    for tree in model.trees:
        table = tree.table()
        open_, values = LW.masks(table, model.edges)
        assert (values[LW.exits(open_, bins)] == np.array(table["value"])[LW.walk(table, bins)]).all()


def flowing(n=700):
    """Rows without splits that part them alike: numbers of their own, and a flag."""
    rng, rows = random.Random(13), []
    for i in range(n):
        x = [rng.gauss(0, 1), rng.gauss(0, 1), float(rng.random() < 0.4)]
        rows.append((float((x[0] > 0.3) ^ (x[2] > 0) or x[1] + rng.gauss(0, 0.4) > 1), x))
    return rows


def test_boosted_trees_are_those_of_mllib(spark, monkeypatch):
    """Thresholds, trees, importances and scores, with a two-valued category as
    the one-hot encoder marks it; the class of the model is MLlib's."""
    x = vectors(spark, flowing()).select("label", F.col("x")[0].alias("a"), F.col("x")[1].alias("b"), F.col("x")[2].alias("c"))
    flagged = OneHotEncoder(inputCol="c", outputCol="f", dropLast=False).fit(x).transform(x)
    df = P.materialize(VectorAssembler(inputCols=["a", "b", "f"], outputCol="features").transform(flagged).select("label", "features"))
    params = dict(maxIter=6, maxDepth=3, stepSize=0.2, minInstancesPerNode=25, seed=3)
    own = gbt.GBTClassifier(**params)
    assert type(own.fit(df)) is type(classification.GBTClassifier(**params).fit(df))
    theirs = classification.GBTClassifier(**params).fit(df)
    calls = []
    grow = gbt.grow
    monkeypatch.setattr(gbt, "grow", lambda *a: calls.append(1) or grow(*a))
    monkeypatch.setattr(gbt, "MLLIB_ROWS", 0)
    for few in (B.FEW_ROWS, 0):  # by the driver and in the cluster
        monkeypatch.setattr(B, "FEW_ROWS", few)
        mine = own.fit(df)
        assert len(calls) == 6 and not calls.clear()
        assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-6)
        got, want = ([r.p[1] for r in m.transform(df).select(vector_to_array("rawPrediction").alias("p")).collect()] for m in (mine, theirs))
        assert np.allclose(got, want, atol=1e-8)
        assert mine.getNumTrees == 6 and mine.treeWeights == theirs.treeWeights
    own.setSubsamplingRate(0.5).fit(df)
    assert not calls  # MLlib draws its rows
