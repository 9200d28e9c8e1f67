"""Session settings the jobs rely on.

* session time zone UTC (timestamps are compared as naive UTC wall clock),
* ANSI mode on (every cleaner uses ``try_*`` so malformed text becomes NULL),
* AQE with partition coalescing and skew-join splitting,
* a checkpoint folder only when the cluster has not named one.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never JIT-compiles a method above 8000 bytes; the wide cleaning
    # projection generates one, so fall back to per-expression codegen instead
    # of running whole-stage code interpreted (documented Spark advice).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every job assumes (idempotent)."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, as they do
    when it is installed or shipped with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    value = spark.sparkContext.getCheckpointDir()
    if value:
        return value
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: ``spark.checkpoint.dir`` names shared
    storage; without it, one below the warehouse is set."""
    value = checkpoint_dir(spark)
    if value:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(value)
        return spark.sparkContext.getCheckpointDir() or value
    # unset (tests): a folder of its own below the warehouse, which is shared
    # wherever tables are
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabprep",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TABPREP_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark
