"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.session import ensure_checkpoint_dir

#: ASCII white space that separates words (fixed values: space, 0x09 to 0x0D).
#: ``bytes.split()`` and ``bytes.lower()`` follow exactly these rules.
WORD_CHARS = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: texts may be long, and a batch is held several times
#: on its way to a worker and back.
BATCH_ROWS = 1000


#: Bits for each key of a set that travels as a literal, and all of them at most (4 MiB).
KEY_BITS = 8
MAX_SET_BITS = 1 << 25


def importable(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> None:
    """Python workers find this package where the driver found it, as they do
    when it is installed or shipped with ``--py-files``, and get small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def give_back() -> None:
    """Memory that is free goes back to the system: the C library keeps it for
    the process otherwise (elsewhere than under glibc only Arrow's goes)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; when a task has ended, its worker, which Spark
    keeps for later tasks and stages, holds none of its memory any more."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage, survives lost executors and, unlike an RDD checkpoint,
    stays columnar, so later reads still prune columns.
    """
    spark = df.sparkSession
    path = folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabprep-llm-{uuid.uuid4().hex}"


def perhaps_in(keys: DataFrame, *by: str) -> Column:
    """False only for rows whose columns ``by`` are those of no row of ``keys``.

    One bit a hash value, so some other rows pass too: what passes still has to
    be joined, and what does not need not be shuffled for it.  The set stops
    growing at ``MAX_SET_BITS``; more keys only let more rows pass."""
    bits = min(MAX_SET_BITS, 64 << max(0, KEY_BITS * keys.count() // 64).bit_length())
    at = F.pmod(F.xxhash64(*by), F.lit(bits))
    one = F.expr("shiftleft(1L, cast(pmod(at, 64) AS INT))")
    found = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    listed = F.split(F.lit(",".join(map(str, words.tolist()))), ",").cast("array<bigint>")  # folded to one literal
    return F.getbit(F.element_at(listed, (F.floor(at / 64) + 1).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def free(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer one that no column has in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row(df: DataFrame, **read: Column) -> DataFrame:
    """Each row whole as ``row`` beside the columns that an operator reads under
    names of its own, so that no input column can clash with what it adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(name) for name, c in read.items()])


def whole_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The input's columns again, from ``row``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.  Spark folds a
    column's expression into every place that mentions it, inside lambdas once
    per element; a lambda variable is not folded."""
    return F.get(F.transform(F.array(value), use), 0)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as ``bytes.lower`` does."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8; null is an empty text."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()
