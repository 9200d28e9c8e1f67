"""Exact global ranks and prefix sums without a single-task window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
The helpers here keep the work distributed:

1. every row gets a deterministic *bucket* whose order matches the sort
   order: the top bits of a uniform hash, or the position among at most
   ``n`` approximate-quantile boundaries (collected once; a bounded list);
2. per-bucket totals (at most buckets x groups rows) get exclusive prefix
   offsets with a small window and come back through an equi-join that adaptive
   execution broadcasts or shuffles by their real size;
3. a window *within* each (group, bucket) finishes the prefix sum.

Callers collapse duplicates first (group by value with a count) so a value
that holds a third of all rows is a single row here and cannot skew a bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.partitioning import materialize

#: Rows of one bucket, which is one task of the window inside buckets.
BUCKET_ROWS = 50_000


def default_buckets(df: DataFrame) -> int:
    """Buckets for a frame whose count is cheap (a materialised one)."""
    return max(8, -(-df.count() // BUCKET_ROWS))


def hash_order(cols) -> Column:
    """A uniform 60-bit non-negative order value from md5 of ``cols``."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_bucket(order60: Column, n_buckets: int) -> Column:
    """Bucket from the top bits of a uniform 60-bit value (monotone in it)."""
    bits = max(1, (int(n_buckets) - 1).bit_length())
    return F.shiftright(order60, 60 - bits).cast("int")


def split_hot_buckets(df: DataFrame, first: str, second: str, bucket: str = "_bucket",
                      rows: int | None = None) -> DataFrame:
    """Buckets of rows ordered by ``first``, then ``second`` (an md5 text), in
    which no value of ``first`` fills a task: a value with more than ``rows``
    rows is cut out of its bucket and into parts by the top bits of ``second``.

    The bucket becomes a struct that orders as the rows do.  Only buckets with
    too many rows are counted by value; the hot values, of which there are at
    most one for every ``rows`` rows, come back by an equi-join on the bucket."""
    rows = rows or BUCKET_ROWS
    crowded = df.groupBy(bucket).count().where(F.col("count") > rows).select(bucket)
    hot = (df.join(crowded, bucket, "left_semi").groupBy(bucket, F.col(first).alias("_v")).count().where(F.col("count") > rows)
           .groupBy(bucket).agg(F.collect_list(F.struct("_v", F.ceil(F.col("count") / rows).alias("parts"))).alias("_hot")))
    hot = materialize(hot)
    if hot.isEmpty():
        return df
    found = F.filter(F.coalesce("_hot", F.array().cast(hot.schema["_hot"].dataType)), lambda h: h["_v"] <= F.col(first))
    own = F.get(F.filter(found, lambda h: h["_v"] == F.col(first)), 0)["parts"]
    # even places lie between hot values, odd ones are a hot value's own
    place = 2 * F.size(found) - F.when(own.isNull(), 0).otherwise(1)
    part = F.shiftright(F.conv(F.substring(second, 1, 7), 16, 10).cast("bigint") * F.coalesce(own, F.lit(0)), 28)
    return df.join(hot, bucket, "left").withColumn(
        bucket, F.struct(F.col(bucket).alias("top"), place.alias("place"), part.alias("part"))).drop("_hot")


def with_quantile_bucket(df: DataFrame, col: str, n_buckets: int, out: str = "_bucket") -> DataFrame:
    """Add a bucket monotone in ``col`` from approximate quantile boundaries.

    The boundary list has at most ``n_buckets - 1`` values (bounded), is
    computed once and is then a literal, so the bucket is deterministic."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.select(F.percentile_approx(F.col(col).cast("double"), probs, max(10_000, 20 * n_buckets)).alias("b")).first()["b"] or []
    splits = [float("-inf")] + sorted(set(float(b) for b in bounds)) + [float("inf")]
    tmp = df.withColumn("_qv", F.col(col).cast("double"))
    res = Bucketizer(splits=splits, inputCol="_qv", outputCol=out, handleInvalid="keep").transform(tmp)
    return res.withColumn(out, F.col(out).cast("int")).drop("_qv")


def exclusive_prefix(df: DataFrame, order_cols: list, weight_cols: list, groups: list = (),
                     bucket: str = "_bucket", with_total: bool = True) -> DataFrame:
    """Add ``<w>_before`` (sum of ``w`` over rows strictly earlier in
    ``order_cols`` within ``groups``) and ``<w>_total`` per weight column.

    ``df`` must carry a ``bucket`` column monotone in ``order_cols``;
    ``order_cols`` must be a total order inside each group."""
    groups = list(groups)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    totals = df.groupBy(*groups, bucket).agg(*[F.sum(w).alias(f"_t_{w}") for w in weight_cols])
    w_before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*groups)
    offs = totals.select(
        *groups, bucket,
        *[F.coalesce(F.sum(f"_t_{w}").over(w_before), F.lit(0)).alias(f"_o_{w}") for w in weight_cols],
        *([F.sum(f"_t_{w}").over(w_all).alias(f"{w}_total") for w in weight_cols] if with_total else []),
    )
    joined = df.join(offs, on=[*groups, bucket], how="inner")
    w_in = (Window.partitionBy(*groups, bucket).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1))
    out = joined.withColumns({
        f"{w}_before": F.col(f"_o_{w}") + F.coalesce(F.sum(w).over(w_in), F.lit(0))
        for w in weight_cols
    })
    return out.drop(bucket, *[f"_o_{w}" for w in weight_cols])


def value_counts(df: DataFrame, value_col: str, groups: list = (), weight: str = "n") -> DataFrame:
    """(groups..., value, n): duplicates collapsed (map-side partial aggregation)."""
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*groups, value_col).agg(F.count(F.lit(1)).alias(weight)))


def exact_quantiles(df: DataFrame, value_col: str, probs: list, groups: list = (),
                    names: list | None = None, n_buckets: int | None = None) -> DataFrame:
    """Linear-interpolated exact quantiles (the rule of SQL ``percentile`` /
    ``quantile_cont``) per group, from value counts and prefix sums."""
    # the value-count table feeds three actions (bucket number, boundaries,
    # result): compute it once
    return quantiles_of(materialize(value_counts(df, value_col, groups)), value_col, probs, groups, names, n_buckets)


def quantiles_of(counts: DataFrame, value_col: str, probs: list, groups: list = (),
                 names: list | None = None, n_buckets: int | None = None) -> DataFrame:
    """:func:`exact_quantiles` of a written :func:`value_counts` table."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    vc = with_quantile_bucket(counts, value_col, n_buckets or default_buckets(counts))
    pref = exclusive_prefix(vc, [value_col], ["n"], groups)
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("n_total") - 1) * F.lit(float(p))
        aggs += [
            F.max(F.when(F.col("n_before") <= F.floor(h), F.col(value_col))).alias(f"_lo_{name}"),
            F.max(F.when(F.col("n_before") <= F.ceil(h), F.col(value_col))).alias(f"_hi_{name}"),
            F.max(h - F.floor(h)).alias(f"_d_{name}"),
        ]
    agg = pref.groupBy(*groups).agg(*aggs)
    return agg.select(*groups, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_d_{n}")).alias(n)
        for n in names
    ])
