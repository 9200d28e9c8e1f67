"""Whitening against numpy's eigenvalues and exact integers."""
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm import queries as Q
from tabprep.llm import whitening as W
from tabprep.llm.common import importable

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def _paths(spark):
    importable(spark)


def brute(rows, scale=256, k=4):
    """vec_id, component -> (n, deviation, whitened up to its sign, explained)."""
    kept = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(x) for _, x in kept), default=0)
    kept = [(i, tuple(x) + (0,) * (width - len(x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(width)]
    away = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(width)] for x in fit])
    e, v = np.linalg.eigh(away.T @ away / n)
    e, v = e[::-1], v[:, ::-1]
    out = []
    for i, x in kept:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        c = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out += [(i, j + 1, n, dev, c @ v[:, j] / np.sqrt(e[j]), e[j] / e.sum()) for j in range(min(k, (e > 1e-9 * e[0]).sum()))]
    return out


def agree(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for j in {r[1] for r in got}:
        a, b = (np.array([r[4] for r in side if r[1] == j]) for side in (got, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8 * max(1, np.abs(b).max())
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_query(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    found = Q.QUERIES["op11_whitening"](spark, SF)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                  "whitened": "double", "explained": "double", "identity_error": "double"}
    got = found.collect()
    agree([tuple(r)[:6] for r in got], brute(rows))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, -3.0]), (1, [1.0, 2.0, -3.0]), (None, [0.5, -2.0, 4.25]), (3, None), (4, [1.0, None, 2.0]),
            (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, [0.1]), (8, [0.1, 0.0, 0.0]), (9, []), (10, [2.0, -0.001, 7.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.select("*", F.lit("c").alias("x"), F.lit(1).alias("component"), F.lit(2).alias("w"))
    got = [tuple(r)[:6] for r in W.whiten(df.repartition(3)).collect()]
    agree(got, brute(rows))
    assert len(got) == 7 * 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.collect() == [] and out.columns[0] == "vec_id" and out.columns[-1] == "identity_error"


def test_far_from_zero_and_huge(spark):
    """Means far beyond the spread cost no digits; sums beyond 64 bits stay exact."""
    rng = np.random.default_rng(3)
    rows = [(i, [1e9 + float(rng.integers(0, 9)), -4e8 + i * 0.5, float(rng.integers(-3, 3))]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    agree([tuple(r)[:6] for r in W.whiten(df).collect()], brute(rows))
    with pytest.raises(Exception, match="beyond"):
        W.whiten(spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (40, 7), (200, 24)])
def test_factor_and_jacobi(shape):
    a = np.random.default_rng(1).integers(-50, 50, size=shape).astype(float)
    if shape[1] > 6:
        a[:, 3] = a[:, 1] + a[:, 2]  # one dimension follows from others
    s = a.T @ a
    low = W.factor(s)
    assert np.allclose(low @ low.T, s, rtol=1e-12, atol=1e-9)
    e, v = W.jacobi(low)
    rank = np.linalg.matrix_rank(a)
    assert len(e) == rank and np.allclose(v.T @ v, np.eye(rank), atol=1e-12)
    assert np.allclose(s @ v, v * e, atol=1e-9 * e[0]) and np.allclose(e, np.linalg.eigvalsh(s)[::-1][:rank], rtol=1e-11)


def test_partitioning_changes_nothing(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, many = (W.fit(df.repartition(k))[0] for k in (1, 7))
    assert one.sums == many.sums and (one.values == many.values).all() and (one.vectors == many.vectors).all()
