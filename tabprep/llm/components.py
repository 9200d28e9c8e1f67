"""Connected components of a link table by alternating star contractions.

Every round is one partial-aggregated minimum per node and one equi-join, so a
node with very many links is combined map-side and its join partition can be
split by adaptive execution.  The table is written to the shared folder after
each round; the driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours over to its smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(u, v)`` of an orderable type -> ``(node, root)`` for every linked
    node; ``root`` is the smallest node of its component.  Loops and repeated
    links are ignored, an empty table gives an empty one."""
    now = stage(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = stage(_small_star(_large_star(now)))
        last, seen = seen, _mark(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
