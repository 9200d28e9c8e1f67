"""Sharding by extendible hashing: a directory over hash-prefix bits.

A row's address is a string of 120 bits: 60 from the MD5 of its key, then 60
from the MD5 of key and row.  The directory starts at zero bits and splits only
buckets over the byte limit, one bit at a time, so each shard is the shortest
prefix that holds at most ``limit`` bytes and its parent more.  The splits are
worked out on a histogram of bytes by prefix, not on the rows: one partially
aggregated shuffle, then sums over all shorter prefixes of its cells.  Cells
that alone are over the limit get a finer histogram in another round.

Rows that share a key share the first 60 bits; a key over the limit (one key
may hold a third of the table) goes on splitting on the bits of its rows.  Rows
that repeat in full and together exceed the limit are written once with 60 more
bits, the MD5 of a number of their own, and split on these.  Only a single row
larger than the limit stays over it, and ``shard_bytes`` tells so.

Main path: DataFrame operations only.

Defined results: a null key is a key of its own and a null text has zero
bytes; repeated rows share a shard while it holds them; an empty table gives an empty result;
columns named like the new ones are replaced, others pass through.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import stage

#: Bytes of text in a shard at most.
SHARD_BYTES = 1 << 20
#: Hex digits of each MD5 that make up the address, and its bits.
DIGITS = 15
ADDRESS_BITS = 2 * 4 * DIGITS
#: Further bits of rows that repeat in full.
COPY_BITS = 4 * DIGITS
#: Bits of a histogram beyond those that an even split needs.
SPARE_BITS = 4
#: Bits that a further round adds.
STEP_BITS = 16


def bits(text: Column) -> Column:
    """The first 60 bits of the text's MD5 as a string of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 2), 4 * DIGITS, "0")


def address(key: Column, row: Column) -> Column:
    name = F.coalesce(key.cast("string"), F.lit("\x00null"))
    return F.concat(bits(name), bits(F.concat_ws("\x1f", name, row.cast("string"))))


def directory(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows(address, bytes)`` -> shards of the cells of ``high`` bits.

    First: ``cell, shard, depth, shard_bytes``, one row per cell that lies in a
    shard; second: ``cell`` of those that need more bits; third: ``cell`` of
    those that hold one address several times over.  Prefixes of ``low`` bits
    are known to be over the limit (or ``low`` is zero).
    """
    cells = stage(rows.groupBy(F.left("address", F.lit(high)).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"),
        F.min("address").alias("least"), F.max("address").alias("most")))
    spread = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn(
        "shard", F.left("cell", F.col("depth")))
    sums = stage(spread.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes")))
    fits, over = sums.where(F.col("shard_bytes") <= limit), sums.where(F.col("shard_bytes") > limit)
    split = over.select(F.col("shard").alias("_parent"))
    top = F.col("depth") == (low if low == 0 else -1)
    leaves = fits.join(split, F.left("shard", F.greatest(F.col("depth") - 1, F.lit(0))) == F.col("_parent"), "left").where(
        top | ((F.col("depth") > low) & F.col("_parent").isNotNull())).drop("_parent")
    full = cells.where(F.col("bytes") > limit)
    alone = full.where(F.col("rows") == 1).select(
        "cell", F.col("cell").alias("shard"), F.lit(high).alias("depth"), F.col("bytes").alias("shard_bytes"))
    found = spread.drop("bytes").join(leaves, ["shard", "depth"]).select("cell", "shard", "depth", "shard_bytes")
    again = full.where(F.col("least") < F.col("most")).select("cell")
    copies = full.where((F.col("least") == F.col("most")) & (F.col("rows") > 1)).select("cell")
    return found.union(alone), again, copies


def place(left: DataFrame, slim: DataFrame, low: int, high: int, most: int, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rows of ``left`` with their shards, in parts, and parts of rows that
    repeat one address of ``most`` bits beyond the limit."""
    placed, repeats = [], []
    while True:
        found, again, copies = directory(slim, low, high, limit)
        here = F.left("address", F.lit(high)) == F.col("cell")
        placed.append(left.join(found, here).drop("cell", "address", "bytes"))
        if not copies.isEmpty():
            repeats.append(left.join(stage(copies), here, "left_semi"))
        if high >= most or again.isEmpty():
            return placed, repeats
        again = stage(again)
        slim = stage(slim.join(again, here, "left_semi"))
        left = left.join(again, here, "left_semi")
        low, high = high, min(most, high + STEP_BITS)


def shards(df: DataFrame, key: Column, size: Column, row: Column, limit: int = SHARD_BYTES) -> DataFrame:
    """``df`` with ``shard`` (the prefix), ``depth`` (its bits) and
    ``shard_bytes``.  ``row`` tells apart the rows of one key."""
    new = ("shard", "depth", "shard_bytes")
    left = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new],
                     address(key, row).alias("address"),
                     F.coalesce(size, F.lit(0)).cast("long").alias("bytes"))
    slim = stage(left.select("address", "bytes"))
    total = slim.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    high = min(ADDRESS_BITS, max(0, math.ceil(math.log2(max(total, 1) / limit))) + SPARE_BITS)
    placed, repeats = place(left, slim, 0, high, ADDRESS_BITS, limit)
    if repeats:
        # written, so that a copy keeps its number in every later read
        copies = stage(reduce(DataFrame.unionByName, repeats).withColumn(
            "address", F.concat("address", bits(F.monotonically_increasing_id().cast("string")))))
        whole = ADDRESS_BITS + COPY_BITS
        more, same = place(copies, copies.select("address", "bytes"), ADDRESS_BITS, ADDRESS_BITS + STEP_BITS, whole, limit)
        if same:
            raise ValueError(f"copies of a row share all {whole} bits of their addresses")
        placed += more
    return reduce(DataFrame.unionByName, placed)
