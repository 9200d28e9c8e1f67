"""Histogram boosting that grows trees leaf by leaf.

Features are cut into bins once.  A tree grows best first: of all leaves the
one whose split gains most is split next, until ``max_leaves``.  A split is
found on a histogram of gradient sums by (node, slot, bin), added up in numpy
arrays by each task and summed by a grouped aggregate; its size is bounded by
the model (``2 * max_leaves`` nodes, slots, bins), not by the data, so the
search itself runs on the driver.  One pass takes the histograms of the
children of every leaf that may still be split, so a tree needs about as many
passes as it is deep.  A slot's most frequent bin is left out of the rows and
comes from the node's totals, so one-hot slots cost only the rows that set them.

Gradients are summed as whole multiples of 2**-20: the model depends neither on
partitioning nor on lost executors.

Defined results: NaN lies in a slot's last bin; a null feature vector or label
is an error; a slot with one value never splits; with one class or no rows no
tree splits and every row gets the prior.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators.partitioning import materialize
from tabprep.plans import boosting as B
from tabprep.plans.boosting import unpacked
from tabprep.session import importable

#: Fixed point of summed gradients.
UNIT = 1 << 20
#: Cells of one pass's histogram at most.
CELLS = 1 << 25


@dataclass(frozen=True)
class Params:
    """Rounds, rate, leaves and L2 are those of the source job."""
    rounds: int = 220
    rate: float = 0.06
    max_leaves: int = 31
    l2: float = 0.05
    least_rows: int = 20
    max_bins: int = 255


@dataclass(frozen=True)
class Split:
    slot: int
    bin: int
    gain: float


@dataclass
class Node:
    """``left`` is how many rows the split sends left."""
    rows: int
    g: int
    h: int
    split: Split | None
    left: int = 0


@dataclass
class Tree:
    """``splits`` and ``values`` by node; the children of node i are 2i (bin at
    most the split's) and 2i + 1."""
    splits: dict[int, Split]
    values: dict[int, float]
    rows: dict[int, int]

    def table(self) -> dict[str, list]:
        """The nodes in arrays, children side by side: a leaf's slot is -1."""
        nodes = [1]
        for node in nodes:
            if node in self.splits:
                nodes += [2 * node, 2 * node + 1]
        at = {node: i for i, node in enumerate(nodes)}
        splits = [self.splits.get(node) for node in nodes]
        return {"node": nodes, "slot": [s.slot if s else -1 for s in splits], "bin": [s.bin if s else 0 for s in splits],
                "left": [at.get(2 * node, 0) for node in nodes], "value": [self.values.get(node, 0.0) for node in nodes],
                "depth": max(nodes).bit_length() - 1}


@dataclass
class LeafwiseModel:
    edges: list[list[float]]
    prior: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def raw(self, features: Column) -> Column:
        """Log odds of a row's features: its leaf of every tree, in their order."""
        edges, prior, tables = self.edges, self.prior, [t.table() for t in self.trees]

        @F.pandas_udf("double")
        def odds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            fast = [masks(table, edges) for table in tables]
            for values in parts:
                bins = np.asfortranarray(bin_matrix(values, edges))
                total = np.full(len(bins), prior)
                for table, own in zip(tables, fast):
                    total += np.array(table["value"])[walk(table, bins)] if own is None else own[1][exits(own[0], bins)]
                yield pd.Series(total)
        return odds(vector_to_array(features))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with the columns that Spark ML's classifiers add."""
        importable(df.sparkSession)
        p = 1 / (1 + F.exp(-F.col("_raw")))
        return df.withColumn("_raw", self.raw(F.col(features))).withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("_raw"), F.col("_raw"))), "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": (F.col("_raw") > 0).cast("double")}).drop("_raw")


# ----------------------------------------------------------------------- bins
def fit_edges(df: DataFrame, features: str = "features", max_bins: int = 255) -> list[list[float]]:
    """Upper edges of every slot's bins but the last: its values where they are
    few, else approximate quantiles."""
    cells = df.select(F.posexplode(vector_to_array(features)).alias("slot", "value")).where(~F.isnan("value"))
    # combined before the shuffle: a one-hot slot sends two rows a task
    values = materialize(cells.distinct())
    n = {r["slot"]: r["n"] for r in values.groupBy("slot").agg(F.approx_count_distinct("value").alias("n")).collect()}
    edges: dict[int, list[float]] = {}
    few = [slot for slot, count in n.items() if count <= max_bins * 0.9]  # the estimate's error is 5 %
    if few:
        for r in values.where(F.col("slot").isin(few)).groupBy("slot").agg(F.collect_set("value").alias("v")).collect():
            if len(r["v"]) <= max_bins:
                edges[r["slot"]] = sorted(r["v"])[:-1]
    many = [slot for slot in n if slot not in edges]
    if many:  # only these slots' rows are read again
        probs = [i / max_bins for i in range(1, max_bins)]
        for r in cells.where(F.col("slot").isin(many)).groupBy("slot").agg(
                F.percentile_approx("value", probs, 10 * max_bins).alias("q")).collect():
            edges[r["slot"]] = sorted(set(r["q"]))
    return [edges.get(i, []) for i in range(max(edges, default=-1) + 1)]


def bin_type(edges: list[list[float]]) -> str:
    """Bytes hold the bins of the default 255."""
    return "<u1" if max(map(len, edges), default=0) < 256 else "<i4"


def bin_matrix(values: pd.Series, edges: list[list[float]]) -> np.ndarray:
    """Rows' bins by slot: how many edges lie below each value."""
    out = np.zeros((len(values), len(edges)), bin_type(edges))
    if len(values):
        table = np.stack(values.to_numpy())
        for i, own in enumerate(edges):
            if len(own) == 1:  # NaN lies above every edge
                out[:, i] = ~(table[:, i] <= own[0])
            elif own:
                out[:, i] = np.searchsorted(np.array(own, dtype=np.float64), table[:, i], side="left")
    return out


def bins_of(features: Column, edges: list[list[float]]) -> Column:
    """The bin of every slot, as an array."""
    @F.pandas_udf("array<int>")
    def bins(values: pd.Series) -> pd.Series:
        return pd.Series(list(bin_matrix(values, edges).astype(np.int32)))
    return bins(vector_to_array(features))


def packed(features: Column, edges: list[list[float]]) -> Column:
    """The bins of every slot side by side in bytes, as passes read them."""
    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in bin_matrix(values, edges)], dtype=object)
    return pack(vector_to_array(features))


# ----------------------------------------------------------------------- trees
def walk(table: dict[str, list], bins: np.ndarray) -> np.ndarray:
    """The place, in the arrays of :meth:`Tree.table`, of the leaf that holds
    each row."""
    slot, cut, left = (np.array(table[k], dtype=np.int64) for k in ("slot", "bin", "left"))
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(table["depth"]):
        own = slot[at]
        at = np.where(own < 0, at, left[at] + (bins[rows, np.maximum(own, 0)] > cut[at]))
    return at


def masks(table: dict[str, list], edges: list[list[float]]) -> tuple[dict[int, np.ndarray], np.ndarray] | None:
    """For each slot that the tree reads, the leaves (as bits, from the left)
    that each bin leaves open, and the leaves' values; None beyond 64 leaves.

    A split closes the leaves of its left side to the rows that go right, so a
    row lies in its lowest open leaf."""
    slot, left = table["slot"], table["left"]
    values: list[float] = []
    open_: dict[int, np.ndarray] = {}

    def leaves(at: int) -> None:
        if slot[at] < 0:
            values.append(table["value"][at])
            return
        begun = len(values)
        leaves(left[at])
        closed = ((1 << len(values)) - 1) ^ ((1 << begun) - 1)
        own = open_.setdefault(slot[at], np.full(len(edges[slot[at]]) + 1, B.ALL, np.uint64))
        own[table["bin"][at] + 1:] &= np.uint64(B.ALL ^ closed)
        leaves(left[at] + 1)

    if slot.count(-1) > 64:
        return None
    leaves(0)
    return open_, np.array(values)


def exits(open_: dict[int, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The place of each row's leaf among the values of :func:`masks`."""
    left = np.full(len(bins), B.ALL, np.uint64)
    for slot, own in open_.items():
        left &= own[bins[:, slot]]
    return B.lowest(left)


@dataclass(frozen=True)
class Layout:
    """Bins of each slot, and the bin of each that passes leave out (-1: none)."""
    sizes: list[int]
    common: list[int]

    def kind(self) -> str:
        return "<u1" if max(self.sizes, default=0) <= 256 else "<i4"


def histograms(rows: DataFrame, splits: dict[int, Split], nodes: list[int], layout: Layout) -> DataFrame:
    """``node, slot, bin, rows, g, h`` over the rows of ``nodes``; slot -1 holds
    a node's totals, and bins not listed hold the rest.

    A task adds up its rows in arrays as large as the model and returns one row
    a cell; whole numbers below 2**53, so the sums are exact."""
    p = 1 / (1 + F.exp(-F.col("score")))
    held = rows.select("_bins", F.round((p - F.col("label")) * UNIT).cast("long").alias("g"), F.round(p * (1 - p) * UNIT).cast("long").alias("h"))
    table, kind, slots = Tree(splits, {}, {}).table(), layout.kind(), len(layout.sizes)
    first = np.concatenate([[0], np.cumsum(layout.sizes)]).astype(np.int64)
    place = {node: i for i, node in enumerate(nodes)}
    wanted = np.array([place.get(node, -1) for node in table["node"]], np.int64)
    common = np.array(layout.common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = np.zeros((3, len(nodes) * int(first[-1])))
        total = np.zeros((3, len(nodes)))
        for batch in batches:
            if any(column.null_count for column in batch.columns):
                raise ValueError("a label or feature vector is null")
            bins = unpacked(batch.column(0), slots, kind)
            own = wanted[walk(table, bins)]
            at = np.flatnonzero(own >= 0)
            bins, own = bins[at], own[at]
            row, slot = np.nonzero(bins != common)
            cell = own[row] * first[-1] + first[slot] + bins[row, slot]
            for i, weight in enumerate((None, *(batch.column(k).to_numpy()[at] for k in (1, 2)))):
                total[i] += np.bincount(own, weight, minlength=len(nodes))
                inner[i] += np.bincount(cell, None if weight is None else weight[row], minlength=inner.shape[1])
        cells, sums = np.flatnonzero(inner[0]), np.flatnonzero(total[0])
        node, left = np.divmod(cells, max(int(first[-1]), 1))
        slot = np.searchsorted(first, left, side="right") - 1
        names = np.array(nodes, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([names[node], names[sums]])),
             pa.array(np.concatenate([slot, np.full(len(sums), -1)]).astype(np.int32)),
             pa.array(np.concatenate([left - first[slot], np.zeros(len(sums))]).astype(np.int32)),
             *[pa.array(np.concatenate([inner[i][cells], total[i][sums]]).astype(np.int64)) for i in range(3)]],
            names=["node", "slot", "bin", "rows", "g", "h"])

    parts = held.mapInArrow(run, "node long, slot int, bin int, rows long, g long, h long")
    return parts.groupBy("node", "slot", "bin").agg(*[F.sum(c).alias(c) for c in ("rows", "g", "h")])


def best_split(cells: np.ndarray, total: list[int], slot_of: np.ndarray, first: np.ndarray, p: Params) -> Node:
    """The best split of a node with sums ``cells`` (rows, g, h by slot's bin)."""
    upto = np.concatenate([np.zeros((3, 1), np.int64), cells.cumsum(axis=1)], axis=1)
    left = upto[:, 1:] - upto[:, first][:, slot_of]
    right = np.array(total)[:, None] - left
    n, g, h = (x / s for x, s in zip(left, (1, UNIT, UNIT)))
    rn, rg, rh = (x / s for x, s in zip(right, (1, UNIT, UNIT)))
    tg, th = total[1] / UNIT, total[2] / UNIT
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (h + p.l2) + rg * rg / (rh + p.l2) - tg * tg / (th + p.l2)
    gain[(n < p.least_rows) | (rn < p.least_rows) | ~np.isfinite(gain)] = -np.inf
    best = int(gain.argmax())  # ties: the first slot, then the first bin
    slot, top = int(slot_of[best]), float(gain[best])
    return Node(*total, Split(slot, best - int(first[slot]), top) if top > 1e-9 else None, int(n[best]))


def grow(over: B.Passes, p: Params) -> tuple[Tree, float]:
    """One tree, best first, and the summed log loss of the scores it starts
    from; histograms are taken for several leaves at once."""
    sizes = over.packing.sizes
    slot_of, first = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])[:-1]

    def look(nodes: list[int]) -> None:
        known.update({i: best_split(found.cells(i), found.total(i), slot_of, first, p) for i in nodes})

    known: dict[int, Node] = {}
    found = B.Histograms(over)
    if 1 not in found.held:
        return Tree({}, {1: 0.0}, {1: 0}), 0.0
    loss = found.measure(1)
    look([1])
    splits: dict[int, Split] = {}
    leaves = [1]
    while len(leaves) < p.max_leaves:
        open_ = sorted((i for i in leaves if known[i].split), key=lambda i: (-known[i].split.gain, i))
        if not open_:
            break
        node = open_[0]
        if 2 * node not in known:
            wanted = [i for i in open_[:p.max_leaves - len(leaves)] if 2 * i not in known]
            tried = {**splits, **{i: known[i].split for i in wanted}}
            found.split(tried, {i: known[i].left for i in wanted})
            look([c for i in wanted for c in (2 * i, 2 * i + 1)])
        splits[node] = known[node].split
        leaves.remove(node)
        leaves += [2 * node, 2 * node + 1]
    return Tree(splits, {i: -p.rate * (known[i].g / UNIT) / (known[i].h / UNIT + p.l2) for i in leaves}, {i: known[i].rows for i in leaves}), loss


def gradients(label: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-score))
    return np.rint((p - label) * UNIT), np.rint(p * (1 - p) * UNIT)


def log_loss(label: np.ndarray, score: np.ndarray) -> np.ndarray:
    return np.maximum(score, 0.0) - score * label + np.log1p(np.exp(-np.abs(score)))


def binned(df: DataFrame, edges: list[list[float]], features: str = "features", label: str = "label"):
    """The rows as bins, written once, and each slot's bins and most frequent
    one, which passes leave out."""
    importable(df.sparkSession)
    rows = materialize(df.select(F.col(label).cast("double").alias("label"), packed(F.col(features), edges).alias("_bins")))
    sizes = [len(e) + 1 for e in edges]
    counts = histograms(rows.withColumn("score", F.lit(0.0)), {}, [1], Layout(sizes, [-1] * len(sizes)))
    tops = counts.where("slot >= 0").groupBy("slot").agg(F.max_by("bin", F.struct("rows", -F.col("bin"))).alias("bin")).collect()
    top = {r["slot"]: r["bin"] for r in tops}
    return rows, Layout(sizes, [top.get(i, 0) for i in range(len(edges))])


def fit(df: DataFrame, p: Params = Params(), features: str = "features", label: str = "label") -> LeafwiseModel:
    edges = fit_edges(df, features, p.max_bins)
    sizes = [len(e) + 1 for e in edges]
    if 2 * p.max_leaves * len(sizes) * max(sizes, default=1) > CELLS:
        raise ValueError(f"{len(sizes)} slots of up to {max(sizes)} bins make a histogram of over {CELLS} cells")
    rows, layout = binned(df, edges, features, label)
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    share = min(max((ones or 0.0) / max(n, 1), 1e-6), 1 - 1e-6)
    model = LeafwiseModel(edges, math.log(share / (1 - share)))
    if not n or not sizes:
        model.losses = [0.0]
        return model
    packing = B.Packing(sizes, layout.common, B.bundled(rows, len(sizes), layout.kind(), layout.common, sizes))
    over = B.passes(rows, packing, layout.kind(), model.prior, gradients, log_loss)
    try:
        for _ in range(p.rounds):
            tree, loss = grow(over, p)
            model.trees.append(tree)
            model.losses.append(loss / n)
            over.raise_scores(tree.splits, tree.values)
        model.losses.append(over.measured() / n)
    finally:
        over.end()
    return model
