"""SimHash near-duplicates: a binary trie self-join of the fingerprints.

1. *Fingerprints* (Arrow batches): words, word shingles with their repeats,
   XXH64 of each shingle; a bit is set if it is set in over half the hashes.
2. *Distinct fingerprints.*  Copies collapse before any pair is looked at.
3. *Trie self-join.*  With an error budget of k bits and m blocks of bits, any
   two linked fingerprints agree on at least m - k blocks.  For each choice of
   m - k blocks the chosen bits are moved to the top of the trie; below one
   top node both sides are walked together: a pair of nodes is replaced by its
   child pairs, differing bits are added up, and a pair whose sum exceeds the
   budget is dropped with everything below it.  All top nodes of a Spark
   partition are walked at once, a level at a time, as numpy arrays; a frontier
   that grows beyond a bound is walked in slices, so memory stays bounded.
4. A top node with more than ``GROUP`` fingerprints (a large group of near
   copies) is split into runs of leaves; each pair of runs is a task of its own.
5. A task returns a spanning forest of the links it found, never all pairs.
   Components of the forest are the components of all links.

Defined results: null texts count as empty; a text without words has
fingerprint zero and is linked like any other; rows with a null id keep their
row and take no part in the component's smallest id (null if no row has one);
repeated rows repeat, except in ``keep_one``, where one row of each component
stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import lean, perhaps_in, whole_rows, with_row, require, stage, words_of
from tabprep.llm.components import components

BITS = 64
SEED = 42
#: Stands for a missing id in comparisons.
NO_ID = (1 << 63) - 1
#: Fingerprints below one top node that a task walks against each other.
GROUP = 2048
#: Node pairs walked at once.
FRONTIER = 1_000_000
#: Fingerprints expected below a top node when the number of blocks is chosen.
TARGET_GROUP = 64


# ------------------------------------------------------------- fingerprints
def fingerprint(words: list[bytes], width: int) -> int:
    import xxhash

    if not words:
        return 0
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    text = b" ".join(words)
    last = min(width, len(words)) - 1
    starts = [0] + [e + 1 for e in ends[:len(ends) - last - 1]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[s:e], SEED) for s, e in zip(starts, ends[last:])], dtype="<u8")
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, width: int, text_col: str, id_col: str) -> DataFrame:
    """``doc_id, key, fp``, one row per row; ``key`` is a hash of the text, ``fp``
    the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(words_of(t.as_py()), width) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "key", "fp"])

    held = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_key(text_col), F.col(f"`{text_col}`").cast("string").alias("t"))
    return held.mapInArrow(lean(run), "doc_id long, key long, fp long")


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("key")


# ------------------------------------------------------------------ the trie
def block_edges(blocks: int) -> list[int]:
    return [round(k * BITS / blocks) for k in range(blocks + 1)]


def choose_blocks(n: int, budget: int) -> int:
    """Fewest blocks whose common top leaves about TARGET_GROUP fingerprints."""
    need = math.log2(max(n, 1) / TARGET_GROUP) if n > TARGET_GROUP else 0
    for blocks in range(budget + 1, budget + 5):
        if (blocks - budget) * (BITS // blocks) >= need:
            return blocks
    return budget + 4


def _bits(fp: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def walk(top: np.ndarray, fps: np.ndarray, side: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each top node.

    ``top``: number of the top node of every row; ``side``: 0 if the row is
    paired with the rows of its own run, else 1 or 2 for the two runs that are
    paired with each other.  Returns positions of linked rows, a forest.
    """
    n = len(fps)
    if not n:
        return np.zeros(0, int), np.zeros(0, int)
    order = np.lexsort((fps, side, top))
    keys, group = fps[order], top[order].astype(np.int64) * 3 + side[order]
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    lo, hi, name = cuts[:-1], cuts[1:], group[cuts[:-1]]
    own = name % 3 == 0
    pairs = [np.stack([lo[own], hi[own], lo[own], hi[own]])]
    first = np.flatnonzero((name[:-1] % 3 == 1) & (name[1:] == name[:-1] + 1)) if len(name) > 1 else np.zeros(0, int)
    pairs.append(np.stack([lo[first], hi[first], lo[first + 1], hi[first + 1]]))
    start = np.concatenate(pairs, axis=1)
    parent = np.arange(n)
    forest: list[np.ndarray] = []
    todo = [(0, start, np.zeros(start.shape[1], dtype=np.int8))]
    while todo:
        depth, nodes, errors = todo.pop()
        while nodes.shape[1] and depth < BITS:
            if nodes.shape[1] > FRONTIER:
                half = nodes.shape[1] // 2
                todo.append((depth, nodes[:, half:], errors[half:]))
                nodes, errors = nodes[:, :half], errors[:half]
            leaf = (nodes[1] - nodes[0] == 1) & (nodes[3] - nodes[2] == 1)
            if leaf.any():
                a, b = nodes[0, leaf], nodes[2, leaf]
                keep = (a != b)
                a, b = a[keep], b[keep]
                near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
                _join(parent, a[near], b[near], forest)
                nodes, errors = nodes[:, ~leaf], errors[~leaf]
            # children: where the next bit turns to one inside each node
            bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
            ones = np.concatenate([[0], np.cumsum((keys & bit) != 0)])
            am = nodes[1] - (ones[nodes[1]] - ones[nodes[0]])
            bm = nodes[3] - (ones[nodes[3]] - ones[nodes[2]])
            same = (nodes[0] == nodes[2]) & (nodes[1] == nodes[3])
            zero = np.stack([nodes[0], am, nodes[2], bm])
            one = np.stack([am, nodes[1], bm, nodes[3]])
            left = np.stack([nodes[0], am, bm, nodes[3]])
            right = np.stack([am, nodes[1], nodes[2], bm])
            cross = errors < budget
            parts = [(zero, errors), (one, errors), (left[:, cross], errors[cross] + 1),
                     (right[:, cross & ~same], errors[cross & ~same] + 1)]
            kept = []
            for child, count in parts:
                full = (child[1] > child[0]) & (child[3] > child[2])
                alone = (child[0] == child[2]) & (child[1] - child[0] == 1) & (child[3] == child[1])
                full &= ~alone
                kept.append((child[:, full], count[full].astype(np.int8)))
            nodes = np.concatenate([k[0] for k in kept], axis=1)
            errors = np.concatenate([k[1] for k in kept])
            depth += 1
        if nodes.shape[1]:  # all bits walked: the rows of both nodes are linked
            for a0, a1, b0, b1 in nodes.T:
                a = np.r_[np.arange(a0, a1), np.arange(b0 + 1, b1)]
                b = np.r_[np.full(a1 - a0, b0), np.full(max(b1 - b0 - 1, 0), b0)]
                _join(parent, a, b, forest)
    links = np.concatenate(forest, axis=1) if forest else np.zeros((2, 0), int)
    return order[links[0]], order[links[1]]


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray, forest: list[np.ndarray]) -> None:
    """Merge linked rows; keep only links that merged something."""
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        if not len(a):
            return
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        # one link per larger root: hook it to the smallest partner
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        parent[high[first]] = low[first]
        forest.append(np.stack([a[first], b[first]]))


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    root = parent[x]
    while True:
        up = parent[root]
        if (up == root).all():
            parent[x] = root
            return root
        root = up


def links(fps: DataFrame, budget: int, blocks: int | None = None) -> DataFrame:
    """``fps(fp)`` distinct -> forest ``(u, v)`` whose components are those of
    all pairs at ``budget`` or fewer differing bits."""
    fps = stage(fps)
    blocks = blocks or choose_blocks(fps.count(), budget)
    edges = block_edges(blocks)
    tops = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - budget)):
        value = F.lit(0).cast("long")
        for block in chosen:
            low, high = edges[block], edges[block + 1]
            value = F.shiftleft(value, high - low).bitwiseOR(_bits(F.col("fp"), low, high))
        tops.append(F.struct(F.lit(number).alias("choice"), value.alias("top")))
    rows = fps.select("fp", F.explode(F.array(*tops)).alias("t")).select("fp", "t.choice", "t.top")
    # split large top nodes into runs; every pair of runs becomes a task
    large = rows.groupBy("choice", "top").count().where(F.col("count") > GROUP).select(
        "choice", "top", F.ceil(F.col("count") / GROUP).cast("int").alias("runs"))
    run = F.pmod(F.xxhash64("fp"), F.col("runs")).cast("int")
    tasks = rows.join(large, ["choice", "top"], "left").withColumn("runs", F.coalesce("runs", F.lit(1))).withColumn(
        "run", run).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
    tasks = tasks.select("choice", "top", F.least("run", "other").alias("i"), F.greatest("run", "other").alias("j"),
                         F.when(F.col("run") == F.col("other"), 0).when(F.col("run") < F.col("other"), 1)
                         .otherwise(2).cast("byte").alias("side"), "fp")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:  # sorted: a top node may go on in the next batch
            held.append(batch)
            size += batch.num_rows
            if size < 100_000:
                continue
            whole = _joined(held)
            names = _names(whole)
            ends = np.flatnonzero(names[1:] != names[:-1])
            if len(ends):
                yield _walked(whole.slice(0, ends[-1] + 1), budget)
                whole = whole.slice(ends[-1] + 1)
            held, size = [whole], whole.num_rows
        if size:
            yield _walked(_joined(held), budget)

    keys = ["choice", "top", "i", "j"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(join), "u long, v long")


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _names(batch: pa.RecordBatch) -> np.ndarray:
    """Running number of the task of each row (rows are sorted by task)."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for k in range(4):
        column = batch.column(k).to_numpy(zero_copy_only=False)
        change[1:] |= column[1:] != column[:-1]
    return np.cumsum(change)


def _walked(batch: pa.RecordBatch, budget: int) -> pa.RecordBatch:
    fps = batch.column(5).to_numpy(zero_copy_only=False)
    a, b = walk(_names(batch), fps.view(np.uint64), batch.column(4).to_numpy(zero_copy_only=False), budget)
    return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["u", "v"])


# ----------------------------------------------------------------- operator
def grouped(df: DataFrame, width: int, budget: int, text_col: str, id_col: str, blocks: int | None = None) -> DataFrame:
    """``doc_id, key, fp, component_id`` and ``kept`` (id and key of the row that
    stands for the component; rows without an id come last)."""
    require(df, [text_col, id_col])
    docs = stage(with_fingerprints(df, width, text_col, id_col))
    order = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("key").alias("key"))
    distinct = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(order).alias("first")))
    roots = components(links(distinct.select("fp"), budget, blocks))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", "first", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("kept"))
    by_fp = named.join(ids, "root").select("fp", "component_id", "kept")
    return docs.join(by_fp, "fp")


def near_duplicates(df: DataFrame, width: int = 4, budget: int = 4, text_col: str = "text", id_col: str = "doc_id",
                    blocks: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``df``."""
    return grouped(df, width, budget, text_col, id_col, blocks).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, width: int = 4, budget: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id.
    Columns of any name pass through.  The rows to drop are written first, so
    their size is known when the join is planned.  Whole rows are shuffled only
    where their key may be one of those; all others stay where they are."""
    rows = grouped(df, width, budget, text_col, id_col)
    own = F.coalesce("doc_id", F.lit(NO_ID))
    drop = stage(rows.where((own != F.col("kept.id")) | (F.col("key") != F.col("kept.key")))
                 .select(own.alias("id"), "key").distinct())
    again = stage(rows.groupBy(own.alias("id"), "key").count().where("count > 1").select("id", "key"))
    held = with_row(df, id=F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)), key=text_key(text_col))
    asked = perhaps_in(drop.unionByName(again), "id", "key")
    left = held.where(asked).join(drop, ["id", "key"], "left_anti")
    if not again.isEmpty():
        # rows that repeat id and text: one of each stays
        left = left.join(again, ["id", "key"], "left_anti").unionByName(
            left.join(again, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]))
    return whole_rows(held.where(~asked).unionByName(left), df.columns)
