"""Registered queries: profiling on lineitem and the curated table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import profile as P
from tabprep.operators.partitioning import materialize
from tabprep.registry import CORE_CUR, curated, register, table

# Lineitem schema as supplied (name, Spark simple type).
LINEITEM = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
            ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
            ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
L_NUM = [c for c, t in LINEITEM if t in ("bigint", "int", "double")]
L_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(cols, src) -> str:
    parts = []
    for c, t in cols:
        num = t in ("bigint", "int", "double")
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count, "
            + (f"min({x}) AS min_value, max({x}) AS max_value, round(avg({x}), 9) AS mean, "
               f"round(stddev_samp({x}), 9) AS stddev, count(*) FILTER (WHERE {x} = 0) AS zero_count, "
               "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
               if num else
               "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean, "
               "CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS BIGINT) AS zero_count, "
               f"CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text")
            + f" FROM {src}")
    return " UNION ALL ".join(parts)


@register("profile_lineitem", _profile_sql(LINEITEM, "lineitem"))
def q_profile_lineitem(spark, sf):
    return P.profile(table(spark, sf, "lineitem"))


TOPK_COLS = [c for c, t in LINEITEM if t in ("bigint", "int", "string")]


@register("top_values_lineitem", "SELECT * FROM (SELECT column_name, value, count, CAST(row_number() OVER ("
          "PARTITION BY column_name ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank FROM (SELECT column_name, value, "
          "count(*) AS count FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem" for c in TOPK_COLS)
          + ") GROUP BY 1, 2)) WHERE rank <= 5")
def q_top_values_lineitem(spark, sf):
    return P.top_values(table(spark, sf, "lineitem"), TOPK_COLS, 5)


def _summary_sql(cols, src, pre="") -> str:
    return pre + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 9) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 9) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 9) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 9) AS p50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 9) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {src}"
        for c in cols)


@register("numeric_summary_lineitem", _summary_sql(L_NUM, "lineitem"))
def q_numeric_summary_lineitem(spark, sf):
    return P.numeric_summary(table(spark, sf, "lineitem"), L_NUM)


@register("numeric_summary_curated", _summary_sql(K.NUMERIC_CLEAN_COLUMNS, "curated", CORE_CUR))
def q_numeric_summary_curated(spark, sf):
    return P.numeric_summary(curated(spark, sf), K.NUMERIC_CLEAN_COLUMNS)


@register("correlations_lineitem", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation "
    f"FROM lineitem" for a, b in combinations(L_MEASURES, 2)))
def q_correlations_lineitem(spark, sf):
    return P.correlations(table(spark, sf, "lineitem"), L_MEASURES)


def _hist_sql(c, bins=10) -> str:
    return (f"WITH mm AS (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM lineitem), "
            f"b AS (SELECT CAST(least(floor((CAST({c} AS DOUBLE) - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END) * {bins}), "
            f"{bins - 1}) AS INTEGER) AS bucket FROM lineitem, mm WHERE {c} IS NOT NULL) "
            f"SELECT '{c}' AS column_name, bucket, round(lo + bucket * ((CASE WHEN hi > lo THEN hi - lo ELSE {bins}.0 END) / {bins}), 6) AS lower, "
            f"round(lo + (bucket + 1) * ((CASE WHEN hi > lo THEN hi - lo ELSE {bins}.0 END) / {bins}), 6) AS upper, count(*) AS count "
            f"FROM b, mm GROUP BY bucket, lo, hi")


@register("histogram_lineitem_extendedprice", _hist_sql("l_extendedprice"))
def q_histogram_extendedprice(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10)


@register("histogram_lineitem_quantity", _hist_sql("l_quantity"))
def q_histogram_quantity(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), "l_quantity", 10)


def _profile_table_sql() -> str:
    mode = " UNION ALL ".join(
        f"(SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS top_value, count(*) AS top_count FROM lineitem GROUP BY 2 "
        "ORDER BY count(*) DESC, 2 NULLS FIRST LIMIT 1)" for c in TOPK_COLS)
    quartiles = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 9) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))
        + " FROM lineitem" for c in L_NUM)
    return (f"SELECT * FROM ({_profile_sql(LINEITEM, 'lineitem')}) LEFT JOIN ({quartiles}) USING (column_name) "
            f"LEFT JOIN ({mode}) USING (column_name)")


@register("profile_table_lineitem", _profile_table_sql())
def q_profile_table_lineitem(spark, sf):
    return P.profile_table(table(spark, sf, "lineitem"))


# --------------------------------------------------- A11, A15 mergeable states
@register("profile_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS count, true AS distinct_close, "
    f"{'true' if t in ('bigint', 'int', 'double') else 'CAST(NULL AS BOOLEAN)'} AS median_close FROM lineitem" for c, t in LINEITEM))
def q_profile_sketches(spark, sf):
    """States per return flag and line status, merged: counts, and whether the
    distinct counts are within 8 % and the medians within 3 % in rank."""
    df = table(spark, sf, "lineitem")
    states = materialize(P.sketch_states(df.withColumns({"flag": F.col("l_returnflag"), "status": F.col("l_linestatus")}), by=["flag", "status"]))
    merged = materialize(P.sketch_summary(states, [0.5]))
    exact = P.distinct_counts(df).join(spark.createDataFrame(list(enumerate(df.columns)), "col_idx int, column_name string"), "col_idx")
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in L_NUM])))
    ranks = cells.where("value IS NOT NULL").join(merged.select("column_name", "p50"), "column_name").groupBy("column_name").agg(
        (F.count_if(F.col("value") < F.col("p50")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("value") <= F.col("p50")) / F.count(F.lit(1))).alias("upto"))
    return merged.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "row_count", "count",
        (F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= 1 + 0.08 * F.col("distinct_count")).alias("distinct_close"),
        ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_close"))
