"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then
one-sided Jacobi directly on the triangular factor.

Entries become integers, floor(scale * c).  The components are fitted on the
*fit list*, every distinct integer vector once, which is written to the shared
folder.  Tasks add up their part of the scatter: the integer nearest each mean
is subtracted before anything is multiplied, so products are small and their
sums are exact integers in any order; what is left of the mean, below one half,
is taken off exactly at the end.  A lost executor or another partitioning
therefore changes no bit of the result.

The scatter has as many rows as a vector has entries, whatever the number of
vectors; only it reaches the driver, where ``factor`` writes it as L Lᵀ with
diagonal pivoting and ``jacobi`` rotates the columns of L until they are
orthogonal.  Squared column norms are then the eigenvalues and normalised
columns the components.

Defined results: vectors that are null, or hold a null or non-finite entry, take
no part; a shorter vector counts as padded with zeros; repeated rows count once
in the fit and are all returned; null ids stay; an entry beyond 2^53 after
scaling stops the job (its integer would not be exact); components without
variance are not returned, so a table of one distinct vector, like an empty one,
gives no rows; equal eigenvalues keep the order in which Jacobi left them; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import require, stage

#: Longest vector: its scatter, this squared, is held by the driver and by each task.
MAX_WIDTH = 2048
#: Sweeps of Jacobi; it converges in fewer than ten.
SWEEPS = 60
#: Largest integer that a double holds exactly.
EXACT = 2 ** 53


@dataclass(frozen=True)
class Model:
    """Components as columns, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int

    @property
    def width(self) -> int:
        return len(self.sums)


def quantised(df: DataFrame, vec_col: str, scale: int, *keep: str) -> DataFrame:
    """``x`` (array<long>) of every usable vector, after the columns ``keep``."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    whole = F.transform(vec, lambda c: F.when(F.abs(c * scale) < float(EXACT), F.floor(c * scale))
                        .otherwise(F.raise_error(F.lit(f"an entry is beyond {EXACT} after scaling")).cast("long")))
    usable = vec.isNotNull() & F.forall(vec, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return df.where(usable).select(*[F.col(f"`{c}`") for c in keep], whole.alias("x"))


def fit_list(df: DataFrame, vec_col: str, scale: int) -> DataFrame:
    """Every distinct integer vector once, all of one length, written."""
    found = stage(quantised(df, vec_col, scale).distinct())
    least, most = found.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if (most or 0) > MAX_WIDTH:
        raise ValueError(f"vectors of {most} entries; at most {MAX_WIDTH}")
    if least == most:
        return found
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(most) - F.size("x")))
    return stage(found.select(padded.alias("x")).distinct())


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of entries, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def exact_products(a: np.ndarray) -> np.ndarray:
    """aᵀ a in integers: by doubles where they hold every partial sum, else by
    64-bit or unbounded integers."""
    most = max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0)))) ** 2 * max(1, len(a))
    if most < EXACT:
        return (a.T.astype(np.float64) @ a.astype(np.float64)).astype(np.int64)
    kind = np.int64 if most < 2 ** 63 else object
    return a.T.astype(kind) @ a.astype(kind)


def sums_of(fit: DataFrame, width: int) -> list[int]:
    """Exact sum of each entry over the fit list."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=object)
        for batch in batches:
            total += np.array([int(s) for s in matrix(batch.column(0), width).astype(object).sum(axis=0)], dtype=object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38))], names=["i", "s"])

    found = dict(fit.mapInArrow(part, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s")).collect())
    return [int(found.get(i, 0)) for i in range(width)]


def scatter(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance (divisor n), correctly rounded from its exact value."""
    width = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    upper = np.triu_indices(width)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, middle = np.zeros((width, width), dtype=object), np.array(centre, dtype=np.int64)
        held = np.zeros((width, width), dtype=np.int64)
        for batch in batches:
            new = exact_products(matrix(batch.column(0), width) - middle)
            if new.dtype == object or np.abs(held).max() >= 2 ** 62 - np.abs(new).max():
                total, held = total + held + new, np.zeros((width, width), dtype=np.int64)
            else:
                held = held + new
        total = total + held
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()),
             pa.array([Decimal(int(t)) for t in total[upper]], pa.decimal128(38))], names=["i", "j", "s"])

    rows = fit.mapInArrow(part, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    rest = [s - n * m for s, m in zip(sums, centre)]  # what the integer centre leaves of each sum
    cov = np.zeros((width, width))
    for r in rows:
        cov[r.i, r.j] = cov[r.j, r.i] = (n * int(r.s) - rest[r.i] * rest[r.j]) / (n * n)
    return cov


def factor(a: np.ndarray) -> np.ndarray:
    """L with L Lᵀ = ``a`` (symmetric, no negative eigenvalue): Cholesky with
    the largest remaining diagonal entry as pivot, up to the numerical rank."""
    rest, d = a.astype(np.float64).copy(), len(a)
    low, order = np.zeros((d, d)), np.arange(d)
    least = d * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(rest.diagonal()[k:]))
        if rest[p, p] <= least:
            return low[np.argsort(order), :k]
        for m in (rest, rest.T, low, order):
            m[[k, p]] = m[[p, k]]
        low[k, k] = np.sqrt(rest[k, k])
        low[k + 1:, k] = rest[k + 1:, k] / low[k, k]
        rest[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return low[np.argsort(order)]


def rounds(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``k`` columns once, dealt into rounds of disjoint pairs."""
    ring = list(range(k + k % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:])) if max(a, b) < k]
        out.append((np.array([a for a, _ in pairs], dtype=int), np.array([b for _, b in pairs], dtype=int)))
        ring.insert(1, ring.pop())
    return out


def jacobi(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``low lowᵀ``, falling, and unit eigenvectors as columns:
    plane rotations make the columns of ``low`` orthogonal, all disjoint pairs
    of a round at a time."""
    u = low.copy()
    small = 4 * np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for a, b in rounds(u.shape[1]):
            x, y = u[:, a], u[:, b]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            todo = np.abs(gamma) > small * np.sqrt(alpha * beta)
            if not todo.any():
                continue
            turned = True
            a, b, x, y, gamma = a[todo], b[todo], x[:, todo], y[:, todo], gamma[todo]
            zeta = (beta[todo] - alpha[todo]) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            u[:, a], u[:, b] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.sqrt((u * u).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, u[:, order] / norms[order]


def fit(df: DataFrame, vec_col: str = "embedding", scale: int = 256) -> tuple[Model, DataFrame]:
    """The model, and the fit list it was made from."""
    require(df, [vec_col])
    listed = fit_list(df, vec_col, scale)
    n, width = listed.agg(F.count("*"), F.max(F.size("x"))).first()
    sums = sums_of(listed, width) if n else []
    cov = scatter(listed, n, sums) if sums else np.zeros((0, 0))
    values, vectors = jacobi(factor(cov))
    return Model(n, tuple(sums), values, vectors, float(np.trace(cov)), scale), listed


def projection(model: Model, k: int):
    """Function that whitens rows of integers: x - S/n on the components, over
    the square root of the eigenvalue.  The integer part of the mean is taken
    off first, so that no digits cancel."""
    centre = np.array([s // model.n for s in model.sums], dtype=np.int64)
    rest = np.array([(s - model.n * int(m)) / model.n for s, m in zip(model.sums, centre)])
    axes = model.vectors[:, :k] / np.sqrt(model.values[:k])
    return lambda x: ((x - centre) - rest) @ axes


def identity_error(listed: DataFrame, model: Model, k: int) -> float:
    """Largest entry of whitened's covariance over the fit list, minus the
    identity; measured on the whitened values themselves."""
    project, width = projection(model, k), model.width
    names = [f"m{a}" for a in range(k)] + [f"p{a}_{b}" for a in range(k) for b in range(a + 1)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            w = project(matrix(batch.column(0), width))
            total += np.concatenate([w.sum(0), [w[:, a] @ w[:, b] for a in range(k) for b in range(a + 1)]])
        yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=names)

    found = listed.mapInArrow(part, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).first()
    mean = [found[f"m{a}"] / model.n for a in range(k)]
    return max(abs(found[f"p{a}_{b}"] / model.n - mean[a] * mean[b] - (a == b)) for a in range(k) for b in range(a + 1))


def squared_deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[Decimal]:
    """Exact sum over the entries of (n x - S)²."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most ** 2 * x.shape[1] < 2 ** 63:
        return [Decimal(v) for v in ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(1).tolist()]
    away = x.astype(object) * n - np.array(sums, dtype=object)
    return [Decimal(int(v)) for v in (away * away).sum(1)]


def whiten(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", scale: int = 256, k: int = 4) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n,
    deviation (decimal), whitened, explained, identity_error``."""
    require(df, [id_col, vec_col])
    model, listed = fit(df, vec_col, scale)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, deviation decimal(38,0), w array<double>"
    k = min(k, len(model.values))
    if k == 0:
        none = df.limit(0).select(F.col(f"`{id_col}`").alias("vec_id"))
        return none.select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                           F.lit(0).cast("decimal(38,0)").alias("deviation"),
                           *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    error, project, n, sums = identity_error(listed, model, k), projection(model, k), model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), len(sums))
            flat = pa.array(project(x).ravel())
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(squared_deviation(x, n, sums), pa.decimal128(38)),
                 pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "deviation", "w"])

    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:k]])
    rows = quantised(df, vec_col, scale, id_col).mapInArrow(run, schema)
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
