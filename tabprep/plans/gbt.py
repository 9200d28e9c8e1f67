"""MLlib's boosted trees grown over packed blocks.

:class:`GBTClassifier` is MLlib's estimator and returns MLlib's model.  MLlib
chooses the candidate thresholds itself; the trees are then grown level by
level from the same sums by (node, slot, bin), which :mod:`tabprep.plans.boosting`
takes at a fraction of the cost.  Gains, ties (first slot, then first bin),
leaves and predictions follow MLlib's rules; sums are exact where MLlib's depend
on the order of rows, so where several splits of a node part its rows alike,
rounding no longer decides between them.

Fits of few rows, whose passes cost MLlib no more than the jobs themselves, and
settings that draw rows or features, weigh rows, hold rows out or read
categories of more than two values are left to MLlib.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import classification
from pyspark.ml.linalg import DenseVector
from pyspark.ml.common import _py2java
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.plans import boosting as B
from tabprep.plans import leafwise as LW

#: Fixed point of summed residuals and of their squares.
UNIT, SQUARE = 1 << 30, 1 << 24
#: Rows that MLlib fits itself at most.
MLLIB_ROWS = 1 << 19
#: Impurity below which MLlib makes a child a leaf.
EPSILON = 2.0 ** -52


@dataclass
class Node:
    rows: int
    total: float
    squares: float
    split: LW.Split | None = None
    left: int = 0

    def mean(self) -> float:
        return self.total / self.rows

    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.rows) / self.rows


def module(package, name: str):
    """A Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def labels_alone(label: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the first tree is fitted on: the labels -1 and 1."""
    return (2.0 * label - 1) * UNIT, np.full(len(label), float(SQUARE))


def residuals(label: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The negative gradient of MLlib's log loss."""
    sign = 2.0 * label - 1
    with np.errstate(over="ignore"):
        r = 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))
    return np.rint(r * UNIT), np.rint(r * r * SQUARE)


def variance(rows: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    total = total / UNIT
    return (squares / SQUARE - total * total / rows) / rows


def grow(over: B.Passes, depth: int, least_rows: int, least_gain: float, binary: set[int]) -> dict[int, Node]:
    """One tree's nodes, level by level; of the two values of a ``binary`` slot
    the one of the lower mean counts as left."""
    sizes = over.packing.sizes
    slot_of, first = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])[:-1]
    category = np.isin(slot_of, list(binary))
    found = B.Histograms(over)
    rows, total, squares = found.total(1)
    nodes = {1: Node(rows, total / UNIT, squares / SQUARE)}
    level = [1]
    for left_levels in range(depth, 0, -1):
        parents = {}
        for i in level:
            if abs(nodes[i].impurity()) < EPSILON and i > 1:
                continue
            cells, own = found.cells(i), np.array(found.total(i))
            upto = np.concatenate([np.zeros((3, 1), np.int64), cells.cumsum(axis=1)], axis=1)
            left = upto[:, 1:] - upto[:, first][:, slot_of]
            right = own[:, None] - left
            n, rn = left[0], right[0]
            # as MLlib writes it, so that where sums are whole numbers its rounding is the same
            with np.errstate(divide="ignore", invalid="ignore"):
                a, b = n / own[0] * variance(*left), rn / own[0] * variance(*right)
                turned = category & (right[1] / rn < left[1] / n)
                gain = nodes[i].impurity() - np.where(turned, b, a) - np.where(turned, a, b)
            gain[(n < max(least_rows, 1)) | (rn < max(least_rows, 1))] = -np.inf
            best = int(gain.argmax())  # ties: the first slot, then the first bin
            top = float(gain[best])
            if top <= 0 or top < least_gain:
                continue
            slot = int(slot_of[best])
            nodes[i].split, nodes[i].left = LW.Split(slot, best - int(first[slot]), top), int(n[best])
            parents[i] = nodes[i].left
            for child, side in ((2 * i, left), (2 * i + 1, right)):
                nodes[child] = Node(int(side[0, best]), side[1, best] / UNIT, side[2, best] / SQUARE)
        if left_levels == 1 or not parents:
            break
        found.split({i: nodes[i].split for i in nodes if nodes[i].split}, parents)
        level = [c for i in parents for c in (2 * i, 2 * i + 1)]
    return nodes


class GBTClassifier(classification.GBTClassifier):

    def _plain(self) -> bool:
        get = self.getOrDefault
        return (get("subsamplingRate") == 1.0 and get("featureSubsetStrategy") == "all" and get("minWeightFractionPerNode") == 0.0
                and not (self.isDefined("weightCol") and get("weightCol"))
                and not (self.isDefined("validationIndicatorCol") and get("validationIndicatorCol")))

    def _fit(self, dataset: DataFrame):
        found = self._candidates(dataset) if self._plain() and dataset.count() > MLLIB_ROWS else None
        if found is None:
            return super()._fit(dataset)
        edges, binary = found
        get = self.getOrDefault
        rows, layout = LW.binned(dataset.select(F.col(get("labelCol")).alias("label"), F.col(get("featuresCol")).alias("features")), edges)
        packing = B.Packing(layout.sizes, layout.common, B.bundled(rows, len(edges), layout.kind(), layout.common, layout.sizes))
        over = B.passes(rows, packing, layout.kind(), 0.0, labels_alone, None)
        trees, weights = [], []
        try:
            for k in range(get("maxIter")):
                nodes = grow(over, get("maxDepth"), get("minInstancesPerNode"), get("minInfoGain"), binary)
                trees.append(nodes)
                weights.append(1.0 if k == 0 else get("stepSize"))
                over.raise_scores({i: x.split for i, x in nodes.items() if x.split},
                                  {i: x.mean() * weights[-1] for i, x in nodes.items() if not x.split})
                over.stats = residuals
        finally:
            over.end()
        return self._copyValues(self._create_model(self._model(dataset.sparkSession, trees, weights, edges, binary)))

    def _candidates(self, dataset: DataFrame) -> tuple[list[list[float]], set[int]] | None:
        """MLlib's candidate thresholds of every slot, and which slots are
        categories of two values; None where some have more."""
        jvm = dataset.sparkSession.sparkContext._jvm
        self._transfer_params_to_java()
        java, frame = self._java_obj, dataset._jdf
        arity = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(frame.schema().apply(self.getOrDefault("featuresCol")))
        algo = jvm.org.apache.spark.mllib.tree.configuration.Algo
        strategy = java.getOldBoostingStrategy(arity, algo.Classification()).treeStrategy().copy()
        strategy.setAlgo(algo.Regression())
        rows = module(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(java, frame, jvm.scala.Some(2))
        metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(rows, strategy, 1, "all")
        slots = range(metadata.numFeatures())
        binary = {i for i in slots if arity.contains(i)}
        if any(arity.apply(i) > 2 for i in binary):
            return None
        splits = module(jvm.org.apache.spark.ml.tree.impl, "RandomForest").findSplits(rows, metadata, self.getOrDefault("seed"))
        edges = [[0.0] if i in binary else [s.threshold() for s in splits[i]] for i in slots]
        return edges, binary

    def _model(self, spark, trees: list[dict[int, Node]], weights: list[float], edges: list[list[float]], binary: set[int]):
        """MLlib's model of these trees."""
        sc = spark.sparkContext
        jvm, gateway = sc._jvm, sc._gateway
        # each name is looked up once: a look-up costs a call
        tree, of, part = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange
        inner, leaf, threshold, categories = tree.InternalNode, tree.LeafNode, tree.ContinuousSplit, tree.CategoricalSplit

        def doubles(values: list[float]):
            return _py2java(sc, DenseVector(values)).values()

        def built(nodes: dict[int, Node], sums, at: dict[int, int], i: int):
            """The node with its prediction if it is a leaf."""
            own = nodes[i]
            stats = of(part(sums, at[i], at[i] + 3), own.rows)
            if own.split:
                (left, a), (right, b) = (built(nodes, sums, at, c) for c in (2 * i, 2 * i + 1))
                if a is None or a != b:  # MLlib joins leaves of one prediction
                    slot, cut = own.split.slot, own.split.bin
                    if slot not in binary:
                        split = threshold(slot, edges[slot][cut])
                    else:  # the category of the lower mean goes left
                        turned = nodes[2 * i + 1].mean() < nodes[2 * i].mean()
                        split = categories(slot, doubles([float(turned)]), 2)
                        left, right = (right, left) if turned else (left, right)
                    return inner(own.mean(), own.impurity(), own.split.gain, left, right, split, stats), None
            return leaf(own.mean(), own.impurity(), stats), own.mean()

        name = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        held = gateway.new_array(name, len(trees))
        for k, nodes in enumerate(trees):
            sums = doubles([x for node in nodes.values() for x in (float(node.rows), node.total, node.squares)])
            at = {i: 3 * place for place, i in enumerate(nodes)}
            held[k] = name(built(nodes, sums, at, 1)[0], len(edges))
        return jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, held, doubles(weights), len(edges))
