"""Table profiling: numeric summary (A11), per-column profile and top-k values
(A15), correlation matrix (A16) and histograms (A17).

One wide aggregate computes every per-column statistic in a single scan; the
long form comes from ``inline`` over an array of per-column structs.  Exact
quantiles use the distributed prefix sums of :mod:`tabprep.operators.rank`;
top-k per column is a ``row_number() <= k`` filter, which Spark plans with a
map-side WindowGroupLimit so each map task ships at most k rows per column.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators import rank as R
from tabprep.operators.partitioning import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _kind(dt) -> str:
    if isinstance(dt, NUMERIC):
        return "numeric"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "temporal"
    if isinstance(dt, T.StringType):
        return "text"
    return "other"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _long_values(df: DataFrame, cols) -> DataFrame:
    """(column_name, value double) for every numeric cell (one pass)."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])))


# ------------------------------------------------------------------------ A11
def numeric_summary(df: DataFrame, cols=None, exact: bool = True, probs=(0.25, 0.5, 0.75),
                    digits: int = 9) -> DataFrame:
    """count, mean, stddev (sample), min, 25/50/75 %, max per column, long form.

    ``exact`` uses linear-interpolated exact quantiles; otherwise
    ``percentile_approx`` (one pass, bounded memory)."""
    cols = list(cols or numeric_columns(df))
    names = [f"p{int(round(p * 100))}" for p in probs]
    long = _long_values(df, cols)
    if exact:
        counts = materialize(R.value_counts(long, "value", ["column_name"]))
        stats = _moments(counts)
        q = R.quantiles_of(counts, "value", list(probs), groups=["column_name"], names=names)
        every = long.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
        out = every.join(stats, "column_name", "left").join(q, "column_name", "left").withColumn(
            "count", F.coalesce("count", F.lit(0).cast("long")))
    else:
        out = long.groupBy("column_name").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min"), F.max("value").alias("max"),
            *[F.percentile_approx("value", p, 10_000).alias(n) for p, n in zip(probs, names)])
    rnd = ["mean", "stddev", *names]
    return out.select("column_name", "count", *[F.round(c, digits).alias(c) if c in rnd else F.col(c)
                                                for c in ["mean", "stddev", "min", *names, "max"]])


def _moments(counts: DataFrame) -> DataFrame:
    """count, mean, sample stddev, min and max per column from its value counts.
    A first mean is the centre of the second sums, which correct it and give the
    squares without cancellation."""
    n, v = F.col("n"), F.col("value")
    first = counts.groupBy("column_name").agg(F.sum(n).alias("count"), (F.sum(n * v) / F.sum(n)).alias("_m"),
                                              F.min(v).alias("min"), F.max(v).alias("max"))
    off = v - F.col("_m")
    second = counts.join(first.select("column_name", "_m"), "column_name").groupBy("column_name").agg(
        F.sum(n * off).alias("_d"), F.sum(n * off * off).alias("_s"))
    shift, square = F.col("_d") / F.col("count"), F.col("_s") - F.col("_d") * F.col("_d") / F.col("count")
    return first.join(second, "column_name").select(
        "column_name", "count", (F.col("_m") + shift).alias("mean"),
        F.when(F.col("count") > 1, F.sqrt(square / (F.col("count") - 1))).alias("stddev"), "min", "max")


# ------------------------------------------------------------------------ A15
def _slot(f):
    """(long, double, text) slot of a value, typed so distinctness is exact."""
    c, dt = F.col(f.name), f.dataType
    null_l, null_d, null_s = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(dt, INTEGRAL):
        return c.cast("long"), null_d, null_s
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return null_l, c.cast("double"), null_s
    return null_l, null_d, c.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """(col_idx, distinct_count) for every column from ONE shuffle: cells are
    unpivoted into typed slots, de-duplicated (map-side partial aggregation)
    and counted per column.  Unlike several ``count(DISTINCT ...)`` in one
    aggregate, this needs no Expand of every input row per distinct column."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("col_idx"), *[v.alias(n) for v, n in zip(_slot(f), ("lv", "dv", "tv"))])
        for i, f in enumerate(df.schema.fields)])))
    cells = cells.where(F.col("lv").isNotNull() | F.col("dv").isNotNull() | F.col("tv").isNotNull())
    return cells.distinct().groupBy("col_idx").agg(F.count(F.lit(1)).alias("distinct_count"))


def profile(df: DataFrame, exact_distinct: bool = True, digits: int = 9) -> DataFrame:
    """One row per column: type, rows, nulls, distinct, numeric min/max/mean/
    stddev/zeros, text min/max.  One aggregate computes everything except the
    exact distinct counts, which come from :func:`distinct_counts` (one
    shuffle) and join back on the column index (both sides: one row per column)."""
    aggs, structs = [], []
    for i, f in enumerate(df.schema.fields):
        c, kind = f.name, _kind(f.dataType)
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
        num = kind == "numeric"
        if num:
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"_mi{i}"), F.max(x).alias(f"_ma{i}"), F.avg(x).alias(f"_av{i}"),
                     F.stddev_samp(x).alias(f"_sd{i}"), F.count_if(x == 0).alias(f"_z{i}")]
        elif kind in ("text", "temporal"):
            aggs += [F.min(c).cast("string").alias(f"_tmi{i}"), F.max(c).cast("string").alias(f"_tma{i}")]
        null_d, null_s, null_l = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("long")
        structs.append(F.struct(
            F.lit(i).alias("col_idx"),
            F.lit(c).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("null_count"),
            (F.lit(None).cast("long") if exact_distinct else F.col(f"_d{i}").cast("long")).alias("distinct_count"),
            (F.col(f"_mi{i}") if num else null_d).alias("min_value"),
            (F.col(f"_ma{i}") if num else null_d).alias("max_value"),
            (F.round(F.col(f"_av{i}"), digits) if num else null_d).alias("mean"),
            (F.round(F.col(f"_sd{i}"), digits) if num else null_d).alias("stddev"),
            (F.col(f"_z{i}") if num else null_l).alias("zero_count"),
            (F.col(f"_tmi{i}") if kind in ("text", "temporal") else null_s).alias("min_text"),
            (F.col(f"_tma{i}") if kind in ("text", "temporal") else null_s).alias("max_text"),
        ))
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    long = wide.select(F.inline(F.array(*structs)))
    if exact_distinct:
        d = distinct_counts(df).withColumnRenamed("distinct_count", "_dc")
        long = (long.join(d, on="col_idx", how="left")
                .withColumn("distinct_count", F.coalesce(F.col("_dc"), F.lit(0).cast("long"))).drop("_dc"))
    cols = ["column_name", "data_type", "row_count", "null_count", "distinct_count", "min_value", "max_value",
            "mean", "stddev", "zero_count", "min_text", "max_text"]
    return long.orderBy("col_idx").select(*cols)


def top_values(df: DataFrame, cols=None, k: int = 5) -> DataFrame:
    """(column_name, value, count, rank) for the k most frequent values of each
    text/integral column (ties by value).  Values are compared as text."""
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (T.StringType,) + INTEGRAL)]
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])))
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def profile_table(df: DataFrame, digits: int = 9) -> DataFrame:
    """:func:`profile` with exact quartiles of the numeric columns and the most
    frequent value of text and integral ones (all one row per column)."""
    quartiles = numeric_summary(df, digits=digits).select("column_name", "p25", "p50", "p75")
    top = top_values(df, k=1).select("column_name", F.col("value").alias("top_value"), F.col("count").alias("top_count"))
    return profile(df, digits=digits).join(quartiles, "column_name", "left").join(top, "column_name", "left")


# ---------------------------------------------------------- A11, A15 mergeable
#: log2 of a distinct-count sketch's registers (relative error about 1.04 / sqrt(2^12)).
HLL_BITS = 12
#: Items a quantile sketch keeps per level (rank error about 0.65 % at 400).
KLL_ITEMS = 400


def sketch_states(df: DataFrame, by=(), cols=None) -> DataFrame:
    """Mergeable state of each column, per combination of ``by`` (a load date, a
    file, nothing): rows, non-null values, a distinct-count sketch and, for
    numbers, a quantile sketch.  Saved with each load, the states of old loads
    need no second scan; :func:`sketch_summary` merges any of them.

    One scan; a state's size is bounded whatever its rows."""
    by = list(by)
    fields = [f for f in df.schema.fields if f.name not in by and (cols is None or f.name in cols)]
    aggs, structs = [], []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        number = F.when(~F.isnan(c.cast("double")), c.cast("double")) if _kind(f.dataType) == "numeric" else F.lit(None).cast("double")
        aggs += [F.count(c).alias(f"_n{i}"), F.hll_sketch_agg(c.cast("string"), HLL_BITS).alias(f"_h{i}"),
                 F.kll_sketch_agg_double(number, KLL_ITEMS).alias(f"_k{i}")]
        structs.append(F.struct(F.lit(f.name).alias("column_name"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("values"),
                                F.col(f"_h{i}").alias("distinct_state"), F.col(f"_k{i}").alias("quantile_state")))
    wide = (df.groupBy(*by) if by else df).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return wide.select(*by, F.inline(F.array(*structs)))


def sketch_summary(states: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column from the merged states: rows and non-null values
    (exact), distinct count and quantiles (within the sketches' error; NULL
    where a column has no number)."""
    names = [f"p{int(round(p * 100))}" for p in probs]
    merged = states.groupBy("column_name").agg(
        F.sum("rows").alias("row_count"), F.sum("values").alias("count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("approx_distinct"),
        F.kll_merge_agg_double("quantile_state", KLL_ITEMS).alias("_k"))
    held = F.kll_sketch_get_n_double("_k") > 0
    return merged.select("column_name", "row_count", "count", "approx_distinct", *[
        F.when(held, F.kll_sketch_get_quantile_double("_k", F.lit(float(p)))).alias(n) for p, n in zip(probs, names)])


# ------------------------------------------------------------------------ A16
def correlations(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """Pearson correlation for every column pair (a < b in list order), one aggregate."""
    cols = list(cols or numeric_columns(df))
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.round(F.col(f"_c{i}"), digits).alias("correlation"))
        for i, (a, b) in enumerate(pairs)])))


# ------------------------------------------------------------------------ A17
def histogram(df: DataFrame, col: str, bins: int = 10, digits: int = 6) -> DataFrame:
    """Equal-width histogram over [min, max] (the max lands in the last bin).

    min/max are one bounded row collected once; the counting is a grouped
    aggregate with map-side combine."""
    row = df.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "column_name string, bucket int, lower double, upper double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(F.lit(col).alias("column_name"), "bucket",
                         F.round(F.lit(lo) + F.col("bucket") * F.lit(width), digits).alias("lower"),
                         F.round(F.lit(lo) + (F.col("bucket") + 1) * F.lit(width), digits).alias("upper"),
                         "count")
