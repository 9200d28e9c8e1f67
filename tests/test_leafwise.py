"""Leaf-wise histogram boosting against a brute-force version in numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabprep.plans import leafwise as LW

P = LW.Params(rounds=3, max_leaves=6, least_rows=5)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, label double, x array<double>").withColumn("features", array_to_vector("x"))


def sample(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        x = [float(rng.randrange(30)), float(rng.random() < 0.2), 1.0, round(rng.gauss(0, 1), 2)]
        rows.append((i, float((x[0] > 12) ^ (x[1] > 0) or x[3] > 1.5), x))
    return rows


def brute(rows, p):
    """One leaf split at a time, every threshold tried on the raw values."""
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    score = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    leaves_of = []
    for _ in range(p.rounds):
        q = 1 / (1 + np.exp(-score))
        g, h = np.round((q - y) * LW.UNIT) / LW.UNIT, np.round(q * (1 - q) * LW.UNIT) / LW.UNIT

        def worth(m):
            return g[m].sum() ** 2 / (h[m].sum() + p.l2)

        def best(m):
            top = (1e-9, None, None)
            for s in range(x.shape[1]):
                for v in np.unique(x[:, s])[:-1]:
                    a, b = m & (x[:, s] <= v), m & (x[:, s] > v)
                    if a.sum() >= p.least_rows and b.sum() >= p.least_rows:
                        gain = worth(a) + worth(b) - worth(m)
                        if gain > top[0] + 1e-9:
                            top = (gain, a, b)
            return top

        leaves = [(np.ones(len(y), bool), *best(np.ones(len(y), bool)))]
        while len(leaves) < p.max_leaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][1])
            if leaves[at][2] is None:
                break
            _, _, a, b = leaves.pop(at)
            leaves += [(a, *best(a)), (b, *best(b))]
        for m, *_ in leaves:
            score[m] -= p.rate * g[m].sum() / (h[m].sum() + p.l2)
        leaves_of.append(sorted(int(m.sum()) for m, *_ in leaves))
    return score, leaves_of


def test_equals_brute_force(spark):
    rows = sample()
    model = LW.fit(frame(spark, rows), P)
    score, leaves = brute(rows, P)
    assert [sorted(t.rows.values()) for t in model.trees] == leaves
    got = {r.id: r for r in model.transform(frame(spark, rows)).collect()}
    assert [got[i].rawPrediction[1] for i in range(len(rows))] == pytest.approx(list(score), abs=1e-9)
    assert all(got[i].prediction == float(score[i] > 0) for i in got)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))
    again = LW.fit(frame(spark, rows).repartition(7, "id"), P)
    assert again.trees == model.trees and again.edges == model.edges


def test_edges(spark):
    assert LW.fit(frame(spark, []), P).trees == []
    one = LW.fit(frame(spark, [(i, 1.0, [float(i), 2.0]) for i in range(50)]), P)
    assert all(not t.splits for t in one.trees)
    odd = frame(spark, [(0, 0.0, [float("nan"), 2.0]), (1, 1.0, [1.0, 2.0])])
    assert odd.select(LW.bins_of(F.col("features"), [[1.0], []]).alias("b")).orderBy("id").first()["b"] == [1, 0]
    many = frame(spark, [(i, float(i % 2), [i * 0.5]) for i in range(3000)])
    assert 100 < len(LW.fit_edges(many, max_bins=255)[0]) <= 254
    with pytest.raises(ValueError, match="cells"):
        LW.fit(many, LW.Params(max_leaves=1 << 20))
