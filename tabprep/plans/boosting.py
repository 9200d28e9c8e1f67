"""Rows of a boosted fit as packed blocks, and the passes over them.

A fit of hundreds of trees takes over a thousand passes over its rows, so a
pass must cost little by the row and by itself.  Rows are cut into bins once
and held in blocks of numpy columns:

* slots of which no row has two away from their most frequent bins (the one-hot
  slots of a category) share one bundle, found by counting over all rows, and
  small bundles are multiplied into one column, so a row of 125 slots has some
  ten values;
* a pass adds up one whole number a row and column, and only for the smaller
  child of each split: the other is the parent less its sibling, and a slot's
  most frequent bin is the node's total less the others.  All sums are exact,
  so the model depends neither on partitioning nor on lost executors;
* a round's scores are raised in the pass that takes the next tree's first
  histogram.  Blocks are held by Spark (on disk where memory is short) for one
  round, and written to the checkpoint folder now and then, which ends their
  lineage.

What a task returns is bounded by nodes and bins; with many tasks it is added
up by node before it reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from tabprep.session import ensure_checkpoint_dir

#: Rows of a block at most.
BLOCK = 1 << 16
#: Rows that the driver holds itself (some 40 bytes each): a pass over them costs
#: less than a job.  More rows stay in the cluster.
FEW_ROWS = 1 << 19
#: Rows of a task at most.
TASK_ROWS = 1 << 20
#: Values of a column that is the product of bundles.
JOINT = 1 << 10
#: Tasks whose results the driver adds up itself.
DIRECT = 8
ALL = (1 << 64) - 1
#: Rounds after which blocks are written and their lineage ends.
KEPT_ROUNDS = 16


@dataclass
class Packing:
    """Where each slot's bins lie in a block's columns.

    A bundle's state is 0 where all its slots are in their common bins, else
    it names one slot and bin.  ``columns`` lists the bundles multiplied into
    each column."""
    sizes: list[int]
    common: list[int]
    bundles: list[list[int]]
    columns: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        self.states = [1 + sum(self.sizes[s] - 1 for s in b) for b in self.bundles]
        self.start = {}  # slot -> its bundle and first state
        for i, slots in enumerate(self.bundles):
            at = 1
            for s in slots:
                self.start[s] = i, at
                at += self.sizes[s] - 1
        if not self.columns:
            room = []
            for i in sorted(range(len(self.bundles)), key=lambda i: -self.states[i]):
                fits = next((c for c, width in enumerate(room) if width * self.states[i] <= JOINT), None)
                if fits is None:
                    room.append(self.states[i])
                    self.columns.append([i])
                else:
                    room[fits] *= self.states[i]
                    self.columns[fits].append(i)
        self.widths = [int(np.prod([self.states[i] for i in c])) for c in self.columns]
        self.place = {}  # bundle -> its column and stride
        for c, held in enumerate(self.columns):
            stride = 1
            for i in held:
                self.place[i] = c, stride
                stride *= self.states[i]

    def others(self, slot: int) -> np.ndarray:
        """The slot's bins but the common one, in the order of their states."""
        return np.delete(np.arange(self.sizes[slot]), self.common[slot])

    def pack(self, bins: np.ndarray) -> list[np.ndarray]:
        """A block's columns from its bins by row and slot."""
        out = []
        for held, width in zip(self.columns, self.widths):
            value = np.zeros(len(bins), np.int64)
            for i in held:
                stride = self.place[i][1]
                for s in self.bundles[i]:
                    state = np.zeros(self.sizes[s], np.int64)
                    state[self.others(s)] = (self.start[s][1] + np.arange(self.sizes[s] - 1)) * stride
                    value += state[bins[:, s]]
            out.append(value.astype("<u2" if width <= 1 << 16 else "<i4"))
        return out

    def right(self, slot: int, cut: int) -> tuple[int, np.ndarray]:
        """The column that a split reads, and for each of its values whether
        the row goes right (the slot's bin is above ``cut``)."""
        bundle, first = self.start[slot]
        column, stride = self.place[bundle]
        bins = np.full(self.states[bundle], self.common[slot])
        bins[first:first + self.sizes[slot] - 1] = self.others(slot)
        return column, (bins > cut)[np.arange(self.widths[column]) // stride % self.states[bundle]]

    def margins(self, sums: list[np.ndarray]) -> np.ndarray:
        """Sums by (statistic, node, column's value) as sums by (node,
        statistic, bundle's state), bundles side by side."""
        out = [None] * len(self.bundles)
        for held, found in zip(self.columns, sums):
            shape = found.shape[:2] + tuple(self.states[i] for i in reversed(held))
            cube = found.reshape(shape)
            for k, i in enumerate(held):
                axis = len(shape) - 1 - k
                out[i] = cube.sum(axis=tuple(a for a in range(2, len(shape)) if a != axis))
        return np.concatenate(out, axis=2).transpose(1, 0, 2)

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each slot's bins stand among the bundles' states, each slot's
        first bin and its common one, slots side by side."""
        offset, first = (np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in (self.states, self.sizes))
        place = np.zeros(first[-1], np.int64)
        for s, (bundle, state) in self.start.items():
            place[first[s] + self.others(s)] = offset[bundle] + state + np.arange(self.sizes[s] - 1)
        return place, first[:-1], first[:-1] + np.array(self.common, np.int64)


def bundled(rows: DataFrame, slots: int, kind: str, common: list[int], sizes: list[int]) -> list[list[int]]:
    """Slots in bundles of which no row has two away from their common bins."""
    usual = np.array(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros((slots, slots), np.int64)
        for batch in batches:
            away = (unpacked(batch.column(0), slots, kind) != usual).astype(np.float32)
            met += (away.T @ away).astype(np.int64)
        a, b = np.nonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["a", "b"])

    pairs = rows.select("_bins").mapInArrow(run, "a int, b int").distinct().toArrow()
    met = np.zeros((slots, slots), bool)
    met[pairs["a"].to_numpy(), pairs["b"].to_numpy()] = True
    bundles: list[list[int]] = []
    for s in range(slots):
        fits = next((b for b in bundles if not met[s, b].any() and sum(sizes[x] - 1 for x in (*b, s)) < JOINT), None)
        if fits is None:
            bundles.append([s])
        else:
            fits.append(s)
    return bundles


def unpacked(column: pa.Array, slots: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), slots)


Block = tuple  # labels, scores, columns


def blocks(rows: DataFrame, packing: Packing, kind: str, prior: float) -> tuple[RDD, bool]:
    """``rows`` (``label, _bins``, written) as blocks with every score at the
    prior, and whether they are few enough for the driver."""
    slots, spark = len(packing.sizes), rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            labels, bins = (np.concatenate(x) for x in zip(*held))
            columns = b"".join(x.tobytes() for x in packing.pack(bins))
            return pa.RecordBatch.from_arrays([pa.array([labels.tobytes()], pa.binary()), pa.array([columns], pa.binary())],
                                              names=["labels", "columns"])
        for batch in batches:
            if any(column.null_count for column in batch.columns):
                raise ValueError("a label or feature vector is null")
            held.append((batch.column(0).to_numpy(), unpacked(batch.column(1), slots, kind)))
            n += len(batch)
            if n + len(batch) > BLOCK:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    kinds = ["<u2" if width <= 1 << 16 else "<i4" for width in packing.widths]

    def opened(row) -> Block:
        labels, at, columns = np.frombuffer(row[0], np.float64), 0, []
        for kind in kinds:
            columns.append(np.frombuffer(row[1], kind, len(labels), at))
            at += columns[-1].nbytes
        # labels of two classes are held in a byte
        held = labels.astype(np.uint8) if np.isin(labels, (0.0, 1.0)).all() else labels
        return held, np.full(len(labels), prior), columns

    n = rows.count()
    few = n <= FEW_ROWS
    parts = 1 if few else max(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    dealt = rows.select("label", "_bins")
    had = dealt.rdd.getNumPartitions()
    dealt = dealt.coalesce(parts) if parts <= had else dealt.repartition(parts)
    return dealt.mapInArrow(run, "labels binary, columns binary").rdd.map(opened), few


class Router:
    """Places of rows among the nodes ``ends`` of a tree (-1: in none); the
    children of node i are 2i (bin at most the split's) and 2i + 1.

    As bits from the left, a split closes the ends below its left child to the
    rows that go right, so a row lies in its lowest open end: one look-up and
    one conjunction a column, however deep the tree.  Trees of more than 64 ends
    are walked split by split."""

    def __init__(self, packing: Packing, splits: dict, ends):
        self.packing, self.splits, self.place = packing, splits, {node: i for i, node in enumerate(ends)}
        self.ways: set[int] = set()  # the ends and the nodes above them
        for node in ends:
            while node and node not in self.ways:
                self.ways.add(node)
                node //= 2
        self.listed: list[int] = []
        self.open: dict[int, np.ndarray] | None = None
        if len(self.ways - self.place.keys()) < 64:
            self.open = {}
            self._list(1)

    def _list(self, node: int) -> None:
        if node not in self.ways or node in self.place:
            self.listed.append(self.place.get(node, -1))
            return
        begun = len(self.listed)
        self._list(2 * node)
        closed = (1 << len(self.listed)) - (1 << begun)
        column, right = self.packing.right(self.splits[node].slot, self.splits[node].bin)
        own = self.open.setdefault(column, np.full(self.packing.widths[column], ALL, np.uint64))
        own[right] &= np.uint64(ALL ^ closed)
        self._list(2 * node + 1)

    def __call__(self, block: Block) -> np.ndarray:
        columns, n = block[2], len(block[0])
        if self.open is not None:
            left = np.full(n, ALL, np.uint64)
            for column, own in self.open.items():
                left &= own[columns[column]]
            return np.array(self.listed)[lowest(left)]
        out, todo = np.full(n, -1), [(1, np.arange(n))]
        while todo:
            node, at = todo.pop()
            if node in self.place:
                out[at] = self.place[node]
            elif node in self.ways:
                column, goes = self.packing.right(self.splits[node].slot, self.splits[node].bin)
                right = goes[columns[column][at]]
                todo += [(2 * node, at[~right]), (2 * node + 1, at[right])]
        return out


def lowest(bits: np.ndarray) -> np.ndarray:
    """The place of the lowest bit that is set."""
    return np.bitwise_count(~bits & (bits - np.uint64(1)))


def tallied(found: Iterator[Block], packing: Packing, splits: dict, nodes: list[int],
            stats: Callable, measure: Callable | None) -> Iterator[tuple[int, np.ndarray]]:
    """A task's sums for each node by (statistic, bundle's state), the first
    statistic being rows; the node's sum of ``measure`` has the negative key."""
    sums, measured, router = None, np.zeros(len(nodes)), Router(packing, splits, nodes)
    for block in found:
        own = router(block)
        order = np.flatnonzero(own >= 0)
        if not len(order):
            continue
        pick = slice(None) if len(order) == len(own) else order
        own, label, score = own[pick], block[0][pick], block[1][pick]
        weights = stats(label, score)
        if measure:
            measured += np.bincount(own, measure(label, score), len(nodes))
        if sums is None:
            sums = [np.zeros((1 + len(weights), len(nodes), width), np.int64) for width in packing.widths]
        for total, column, width in zip(sums, block[2], packing.widths):
            cell = own * width + column[pick] if len(nodes) > 1 else column[pick].astype(np.int64)
            for i, weight in enumerate((None, *weights)):
                # whole numbers below 2**53 in a block
                total[i] += np.bincount(cell, weight, len(nodes) * width).astype(np.int64).reshape(len(nodes), width)
    if sums is not None:
        yield from zip(nodes, packing.margins(sums))
        if measure:
            yield from ((-node, np.array([x])) for node, x in zip(nodes, measured))


class Passes:
    """The blocks of a fit and its passes over them.

    ``stats`` gives a row's whole numbers to sum, ``measure`` one float (over
    all rows only, or with ``every`` over those of each node that is taken)."""

    def __init__(self, first: RDD, few: bool, packing: Packing, stats: Callable, measure: Callable, every: bool = False):
        self.packing, self.stats, self.measure, self.every = packing, stats, measure, every
        self.sc, self.index = first.context, packing.index()
        self.old: RDD | None = None
        self.state: RDD | list = first.collect() if few else first.persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds, self.written = 0, []

    def tally(self, splits: dict, nodes: list[int]) -> dict[int, np.ndarray]:
        """Sums of each node that holds rows, as :func:`tallied` gives them."""
        packing, stats, measure = self.packing, self.stats, self.measure if self.every or nodes == [1] else None
        if isinstance(self.state, list):
            return dict(tallied(self.state, packing, splits, nodes, stats, measure))
        parts = self.state.mapPartitions(lambda found: tallied(found, packing, splits, nodes, stats, measure))
        if parts.getNumPartitions() > DIRECT:
            parts = parts.reduceByKey(np.add, min(len(nodes), DIRECT))
        out: dict[int, np.ndarray] = {}
        for node, found in parts.collect():
            out[node] = out[node] + found if node in out else found
        if self.old is not None:  # the scores that it led to are held now
            self.old.unpersist()
            self.old = None
            self._forget(1)
        return out

    def raise_scores(self, splits: dict, values: dict[int, float]) -> None:
        """From the next pass on each score is raised by its leaf's value."""
        packing, own = self.packing, np.array([*values.values()])

        def raised(found: Iterator[Block]) -> Iterator[Block]:
            router = Router(packing, splits, values)
            for block in found:
                yield block[0], block[1] + own[router(block)], block[2]

        if isinstance(self.state, list):
            self.state = list(raised(self.state))
            return
        self.old, self.state = self.state, self.state.mapPartitions(raised).persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds += 1
        if self.rounds % KEPT_ROUNDS == 0:
            self.state.checkpoint()
            self.written.append(self.state)

    def measured(self) -> float:
        """The sum of ``measure`` over all rows."""
        measure = self.measure
        if isinstance(self.state, list):
            return float(sum(measure(block[0], block[1]).sum() for block in self.state))
        return float(self.state.map(lambda block: float(measure(block[0], block[1]).sum())).sum())

    def _forget(self, keep: int) -> None:
        """Delete the checkpoints that later ones have replaced."""
        while len(self.written) > keep and (not keep or self.written[-1].isCheckpointed()):
            path = self.written.pop(0).getCheckpointFile()
            if path:
                where = self.sc._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.sc._jsc.hadoopConfiguration()).delete(where, True)

    def end(self) -> None:
        for held in (self.old, self.state):
            if isinstance(held, RDD):
                held.unpersist()
        self._forget(0)


def passes(rows: DataFrame, packing: Packing, kind: str, prior: float, stats: Callable, measure: Callable, every: bool = False) -> Passes:
    ensure_checkpoint_dir(rows.sparkSession)
    return Passes(*blocks(rows, packing, kind, prior), packing, stats, measure, every)


class Histograms:
    """The histograms of one tree's nodes, kept while their children are taken."""

    def __init__(self, over: Passes):
        self.over = over
        self.held = over.tally({}, [1])

    def cells(self, node: int) -> np.ndarray:
        """A node's sums by (statistic, slot's bin), slots side by side."""
        place, first, usual = self.over.index
        out = self.held[node][:, place]
        out[:, usual] = 0
        out[:, usual] = np.array(self.total(node))[:, None] - np.add.reduceat(out, first, axis=1)
        return out

    def total(self, node: int) -> list[int]:
        """A node's sums by statistic."""
        return [int(x) for x in self.held[node][:, :self.over.packing.states[0]].sum(axis=1)]

    def measure(self, node: int) -> float:
        return float(self.held[-node][0])

    def split(self, splits: dict, parents: dict[int, int]) -> None:
        """Take the children of ``parents`` (node: rows that go left) in one
        pass over the smaller ones."""
        small = {i: 2 * i + (2 * left > self.total(i)[0]) for i, left in parents.items()}
        found = self.over.tally(splits, list(small.values()))
        for i, node in small.items():
            for sign in (1, -1):
                if sign * i in self.held:
                    own = found.get(sign * node)
                    whole = self.held.pop(sign * i)
                    if own is None and sign < 0 and not self.over.every:
                        continue
                    self.held[sign * node] = np.zeros_like(whole) if own is None else own
                    self.held[sign * (node ^ 1)] = whole - self.held[sign * node]
