"""Exact top-k by integer inner product: MaxScore over sharded postings.

A vector's dimensions are its terms; a term's posting list holds the integer
component of every vector of a shard.  A query's terms have an upper bound in
the shard: the largest amount the term can add there.  Terms are ordered by how
much they can still change a score.  The first, *essential* terms are traversed
for the whole shard; once the bounds of the rest cannot lift a vector over the
query's current k-th score, the rest are *non-essential*: they are probed, most
telling first, only for vectors that are still competitive.  The k-th score
starts from the shard's vectors of largest norm.  Every bound is exact, so the
result is.

Shards have a bounded number of vectors, queries come in bounded blocks, and a
task holds one shard with one block.  Per-shard winners are merged with a
ranked window that Spark limits to k rows per query before its shuffle.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part; components are floor(scale * x) as 64-bit integers; a shorter
vector counts as padded with zeros; a row that repeats in full counts once; a
query's own id is never its candidate; ties go to the smaller id; an empty
table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import require, stage

#: Vectors in a shard and queries in a block (expected; they are dealt by hash).
SHARD_ROWS = 16_384
BLOCK_ROWS = 2_048
#: Vectors scored in full to find a first k-th score.
SEED_ROWS = 256
#: Non-essential terms probed between two looks at who is still competitive.
PROBE = 8


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id`` and ``v`` (little-endian 64-bit integers) of usable vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0), []
            for x in batch.column(1).to_pylist():
                out.append(np.floor(np.array(x, dtype=np.float64) * scale).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], names=["id", "v"])

    vec = F.col(f"`{vec_col}`").cast("array<double>")
    usable = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda c: F.coalesce((c == c) & (F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False))))
    return usable.mapInArrow(pack, "id long, v binary")


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of components, padded with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors):
        part = np.frombuffer(v, dtype="<i8")
        row[:len(part)] = part
    return out


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """Smallest type in which every partial sum of products is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] * 2
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def shard_top(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, postings: np.ndarray,
              high: np.ndarray, low: np.ndarray, seed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One query against one shard by MaxScore: positions and scores."""
    most, least = np.maximum(query * high, query * low), np.minimum(query * high, query * low)
    order = np.argsort(least - most, kind="stable")  # widest range of contributions first
    rest = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0]])  # bound of the terms from here on
    sure = np.concatenate([np.cumsum(least[order][::-1])[::-1], [0]])
    own = ids[seed] != query_id
    first = vectors[seed[own]] @ query
    floor = np.sort(first)[-k] if len(first) >= k else None
    alive = None
    score = np.zeros(len(ids), dtype=postings.dtype)
    at, terms = 0, len(query)
    while at < terms:
        step = order[at:at + PROBE]
        if alive is None:  # essential terms: traverse their postings
            score += query[step] @ postings[step]
        else:  # non-essential terms: probe the competitive vectors
            score += vectors[np.ix_(alive, step)] @ query[step]
        at += len(step)
        if len(score) > k:
            # what every vector reaches at least also lifts the k-th score (one
            # more, as the query itself may be among them)
            reached = np.partition(score, len(score) - k - 1)[len(score) - k - 1] + sure[at] if len(score) > k + 1 else None
            if reached is not None and (floor is None or reached > floor):
                floor = reached
        if floor is not None:
            keep = score + rest[at] >= floor
            left = int(keep.sum())
            if left < len(keep) // 2:
                alive = np.flatnonzero(keep) if alive is None else alive[keep]
                score = score[keep]
    where = np.arange(len(ids)) if alive is None else alive
    other = ids[where] != query_id
    where, score = where[other], score[other]
    best = np.lexsort((ids[where], -score))[:k]
    return where[best], score[best]


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 64, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, <id_col>, score`` for every row where ``is_query``
    (an expression over ``id``) holds, against all rows."""
    require(df, [id_col, vec_col])
    rows = stage(quantised(df, id_col, vec_col, scale).distinct())
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("v") / 8), F.lit(0)).cast("long")).first()
    queries = rows.where(is_query)
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    tasks = ["block", "shard"]
    side = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    own = rows.select("id", "v", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
                      F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(asked) and len(held):
            q_ids, q = asked["id"].to_numpy(), matrix(asked["v"].tolist(), width)
            ids, vectors = held["id"].to_numpy(), matrix(held["v"].tolist(), width)
            kind = exact_type(q, vectors)
            q, vectors = q.astype(kind), vectors.astype(kind)
            postings = np.ascontiguousarray(vectors.T)
            high, low = vectors.max(axis=0), vectors.min(axis=0)
            norm = (vectors.astype(np.float64) ** 2).sum(axis=1)
            seed = np.argsort(-norm, kind="stable")[:SEED_ROWS]
            for query_id, query in zip(q_ids, q):
                where, score = shard_top(ids, vectors, query_id, query, postings, high, low, seed, k)
                found.append((np.full(len(where), query_id), ids[where], score.astype(np.int64)))
        joined = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else [[]] * 3)]
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), joined)))

    near = side.groupBy(*tasks).cogroup(own.groupBy(*tasks)).applyInPandas(search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
