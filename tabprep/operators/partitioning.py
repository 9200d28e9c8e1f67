"""Partition-count guard for CPU-heavy per-row work.

Cleaning and profiling cost far more CPU per byte than a scan.  A source that
arrives as one large row group (or a tiny AQE-coalesced shuffle) would run
them in a single task.  :func:`spread` round-robins such a frame across the
cluster's default parallelism; when the input already has at least that many
partitions (any multi-file source at scale) it is a no-op and adds no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Call on a freshly read source (a plain file scan).  There, counting
    partitions is pure planning; on a plan with shuffles or broadcasts it would
    execute them just to count, so derived frames are spread through their
    sources instead (see ``fixture.raw``)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(target) if n < target else df


#: Rows of one partition that an iterative fit reads in every pass, in a form
#: many times as large as the compressed file.
FIT_ROWS = 100_000


def spread_rows(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """A written frame (:func:`materialize`) in partitions of about ``rows`` rows
    at most, so that what one task of a fit reads does not grow with the input.

    File partitions follow compressed bytes, and vectors compress so well that
    a partition would hold any number of them.  Small frames stay as they are."""
    n = df.count()
    parts = -(-n // rows)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet below the cluster's shared checkpoint
    folder (``spark.checkpoint.dir``) and read it back.  Later actions read the
    columns they need of the copy, and a lost executor does not force a
    recomputation from the sources."""
    from tabprep.session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabprep-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
