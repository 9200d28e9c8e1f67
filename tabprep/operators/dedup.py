"""De-duplication, deterministic limits, top-k and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import rank as R
from tabprep.operators.partitioning import materialize


# ------------------------------------------------------------------------ D01
def dedup_rows(df: DataFrame, cols=None) -> DataFrame:
    """Whole-row distinct (hash aggregate with map-side partial aggregation)."""
    return df.select(*(cols or df.columns)).distinct()


# ------------------------------------------------------------------------ D02
def dedup_by_key(df: DataFrame, keys=K.BUSINESS_KEY, tie_break=None) -> DataFrame:
    """One survivor per business key; NULL keys compare equal.

    The survivor is the row with the smallest ``tie_break`` tuple (then the
    smallest remaining columns), chosen by ``min(struct(...))`` in a grouped
    aggregate.  Unlike ``row_number()`` over a window, the aggregate combines
    map-side, so a key that holds a third of all rows sends one row per map
    task into the shuffle instead of all of them into one task."""
    keys = list(keys)
    tie_break = list(tie_break or [])
    rest = [c for c in df.columns if c not in keys and c not in tie_break]
    fields = tie_break + rest
    if not fields:
        return df.select(*keys).distinct().select(*df.columns)
    packed = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in fields])).alias("_s"))
    return packed.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in fields]).select(*df.columns)


# ------------------------------------------------------------------------ D05
def row_hash(cols) -> F.Column:
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]))


def cap_rows(df: DataFrame, n: int, order=None) -> DataFrame:
    """Deterministic row cap (0 = off): the ``n`` rows first by ``order`` (default:
    md5 of all columns).  Planned as TakeOrderedAndProject: per-partition top-n,
    then one merge of at most n x partitions rows."""
    if not n:
        return df
    order = order or [row_hash(df.columns)] + [F.col(c) for c in df.columns]
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------------------ D06
def top_k(df: DataFrame, col: str, k: int, tie=()) -> DataFrame:
    return df.orderBy(F.desc(col), *[F.col(c) for c in tie]).limit(k)


def preview(df: DataFrame, n: int = 20, order_by=()) -> DataFrame:
    """Deterministic preview (the first ``n`` rows in ``order_by`` order)."""
    order = list(order_by) or df.columns
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------------------ D07
def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = K.SEED):
    """Native Bernoulli split (depends on input partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


# ------------------------------------------------------------------------ D08
def hash_bucket(key_cols, modulo: int = 100) -> F.Column:
    """0..modulo-1 from the first 32 bits of md5(key); equal in Spark and DuckDB."""
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(modulo))


def hash_split(df: DataFrame, key_cols, train_pct: int = 80, split_col: str = "split") -> DataFrame:
    """Reproducible split: ``train`` when the key's md5 bucket < ``train_pct``."""
    return df.withColumn(split_col, F.when(hash_bucket(key_cols) < train_pct, "train").otherwise("test"))


# ------------------------------------------------------------------------ D09
def expand_counts(df: DataFrame, count_col: str, chunk: int = 100_000) -> DataFrame:
    """Turn each row with ``count_col = c`` back into ``c`` identical rows.

    Rows with ``c <= chunk`` expand in place; larger ones are first cut into
    chunks that are hash-distributed, so a group holding a third of all rows
    is expanded by many tasks, not one."""
    cols = [c for c in df.columns if c != count_col]
    small = df.where(F.col(count_col) <= chunk)
    big = (df.where(F.col(count_col) > chunk)
           .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.floor((F.col(count_col) - 1) / chunk).cast("long"))))
           .withColumn(count_col, F.least(F.lit(chunk).cast("long"), F.col(count_col) - F.col("_chunk") * chunk))
           .repartition(F.xxhash64(*cols, "_chunk"))
           .drop("_chunk"))
    both = small.unionByName(big)
    return both.withColumn("_one", F.explode(F.array_repeat(F.lit(1), F.col(count_col).cast("int")))).select(*cols)


def stratified_split(df: DataFrame, label: str, key_cols=None, test_fraction: float = 0.2,
                     split_col: str = "split", n_buckets: int | None = None) -> DataFrame:
    """Exact per-class ratio: within each class rows are ordered by md5(key)
    (then md5 of the whole row) and the first ``round(n_c * (1 - test_fraction))``
    become ``train``, the rest ``test``.

    Identical rows are collapsed with a count first, the per-class rank is an
    exact distributed prefix count over hash buckets (no window over a whole
    class; a key with many distinct rows gets buckets of its own, cut by the
    row hash), and a collapsed group that straddles the cut is split by count
    and re-expanded in chunks."""
    key_cols = list(key_cols or [c for c in df.columns if c != label])
    cols = df.columns
    # collapsed once: it feeds the bucket totals (size-checked before broadcast)
    # and the in-bucket ranks, so recomputing it would re-aggregate the input
    collapsed = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")))
    n_buckets = n_buckets or R.default_buckets(collapsed)
    work = collapsed.withColumns({
        "_o1": R.hash_order(key_cols),
        "_o2": F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])),
    }).withColumn("_bucket", R.hash_bucket(F.col("_o1"), n_buckets))
    work = R.split_hot_buckets(work, "_o1", "_o2")
    ranked = R.exclusive_prefix(work, ["_o1", "_o2"], ["_c"], groups=[label])
    n_train = F.round(F.col("_c_total") * F.lit(1.0 - test_fraction)).cast("long")
    train_n = F.greatest(F.lit(0).cast("long"), F.least(F.col("_c"), n_train - F.col("_c_before")))
    parts = ranked.withColumn("_train", train_n).select(
        *cols, F.inline(F.array(
            F.struct(F.lit("train").alias(split_col), F.col("_train").alias("_n")),
            F.struct(F.lit("test").alias(split_col), (F.col("_c") - F.col("_train")).alias("_n")))))
    return expand_counts(parts.where(F.col("_n") > 0), "_n")
