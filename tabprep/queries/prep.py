"""Registered queries: ML preparation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from tabprep import constants as K
from tabprep.operators import prep as M
from tabprep.operators import schema as S
from tabprep.registry import CORE_CUR, KEEP, SERVICE, cleaned, curated, register, table

MF_SQL = (CORE_CUR[:-1] + ",\nmf AS (SELECT income, " + ", ".join(K.NUMERIC_FEATURES) + ", "
          + ", ".join(f"COALESCE({c}, 'Unknown') AS {c}" for c in K.CATEGORICAL_FEATURES)
          + " FROM curated WHERE income IN ('<=80k', '>80k'))\n")


def _mf(spark, sf):
    return S.model_frame(curated(spark, sf), "full")


@register("label_index", MF_SQL + "SELECT income, CAST(CASE WHEN income = '<=80k' THEN 0 ELSE 1 END AS DOUBLE) AS label, "
          "count(*) AS count FROM mf GROUP BY 1, 2")
def q_label_index(spark, sf):
    mf = _mf(spark, sf)
    out = M.label_stage().fit(mf).transform(mf)
    return out.groupBy("income", "label").agg(F.count(F.lit(1)).alias("count"))


def _cat_index_sql(src: str, cols, pre: str) -> str:
    return pre + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, value, CAST(row_number() OVER (ORDER BY count DESC, value) - 1 AS DOUBLE) AS index, "
        f"count FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS count FROM {src} GROUP BY 1)" for c in cols)


def _cat_index(df, cols):
    model = Pipeline(stages=M.category_stages(cols)).fit(df)
    out = model.transform(df)
    long = out.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.col(f"{c}_idx").alias("index"))
        for c in cols])))
    return long.groupBy("column_name", "value", "index").agg(F.count(F.lit(1)).alias("count"))


@register("category_index", _cat_index_sql("mf", K.CATEGORICAL_FEATURES, MF_SQL))
def q_category_index(spark, sf):
    return _cat_index(_mf(spark, sf), K.CATEGORICAL_FEATURES)


PART_CATS = ["p_brand", "p_type", "p_size"]


@register("category_index_part", _cat_index_sql("part", PART_CATS, ""))
def q_category_index_part(spark, sf):
    p = table(spark, sf, "part").select(*[F.col(c).cast("string").alias(c) for c in PART_CATS])
    return _cat_index(p, PART_CATS)


@register("impute_exact_median", MF_SQL + "SELECT income, " + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM mf)) AS {c}" for c in K.NUMERIC_FEATURES)
    + " FROM mf")
def q_impute_exact(spark, sf):
    mf = _mf(spark, sf).select("income", *K.NUMERIC_FEATURES)
    return M.impute_exact(mf, K.NUMERIC_FEATURES)


@register("impute_approx_median")
def q_impute_approx(spark, sf):
    mf = _mf(spark, sf).select("income", *K.NUMERIC_FEATURES)
    return M.imputer_stage().fit(mf).transform(mf)


# The vocabulary the fixture produces for these service-cleaned columns.
OHE_VOCAB = {
    "sex": ["female", "male"],
    "race": ["asian", "black", "unknown", "white"],
    "relationship": ["husband", "own-child", "wife"],
    "source_system": ["api", "crm", "web"],
    "random_flag": ["n", "unknown", "y"],
}


@register("onehot_ignore", SERVICE + "SELECT record_id, copy_no, " + ", ".join(
    f"CAST(COALESCE({c}, 'unknown') = '{v}' AS INTEGER) AS {c}__{S.standardize_name(v)}"
    for c, vs in OHE_VOCAB.items() for v in vs) + " FROM clean_s")
def q_onehot_ignore(spark, sf):
    df = cleaned(spark, sf, "service")
    return M.onehot_ignore(df, list(OHE_VOCAB), keep=KEEP)


@register("onehot_keep")
def q_onehot_keep(spark, sf):
    mf = _mf(spark, sf)
    cats = K.CATEGORICAL_FEATURES_6
    model = Pipeline(stages=M.category_stages(cats) + [M.onehot_stage(cats)]).fit(mf)
    return model.transform(mf).select("income", *[f"{c}_ohe" for c in cats])


L_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(with_mean: bool, pop: bool) -> str:
    fn = "stddev_pop" if pop else "stddev_samp"
    cols = []
    for c in L_MEASURES:
        x = f"({c} - (SELECT avg({c}) FROM lineitem))" if with_mean else c
        cols.append(f"round({x} / (SELECT {fn}({c}) FROM lineitem), 6) AS {c}_scaled")
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(cols) + " FROM lineitem"


def _scale(spark, sf, with_mean, pop):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *L_MEASURES)
    out = M.standardize(li, L_MEASURES, with_mean=with_mean, population=pop, digits=6)
    return out.select("l_orderkey", "l_linenumber", *[f"{c}_scaled" for c in L_MEASURES])


@register("standardize_sample", _scale_sql(True, False))
def q_standardize_sample(spark, sf):
    return _scale(spark, sf, True, False)


@register("scale_std_only", _scale_sql(False, False))
def q_scale_std_only(spark, sf):
    return _scale(spark, sf, False, False)


@register("standardize_population", _scale_sql(True, True))
def q_standardize_population(spark, sf):
    return _scale(spark, sf, True, True)


@register("class_weights", MF_SQL + "SELECT income, (SELECT count(*) FROM mf) / ((SELECT count(DISTINCT income) FROM mf) "
          "* count(*)) AS class_weight, count(*) AS count FROM mf GROUP BY income")
def q_class_weights(spark, sf):
    w = M.class_weights(_mf(spark, sf).select("income"))
    return w.groupBy("income", "class_weight").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------- M02, M06 with a vocabulary table
TABLE_CATS = ["o_custkey", "o_orderkey", "o_orderstatus"]


def _orders_text(spark, sf):
    return table(spark, sf, "orders").select(*[F.col(c).cast("string").alias(c) for c in TABLE_CATS])


@register("category_index_table", _cat_index_sql("orders", TABLE_CATS, ""))
def q_category_index_table(spark, sf):
    """Indices of columns with as many values as rows, through the joined table."""
    df = _orders_text(spark, sf)
    out = M.index_by_table(df, TABLE_CATS, M.vocabulary_table(df, TABLE_CATS))
    long = out.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(f"{c}_idx").alias("index")) for c in TABLE_CATS])))
    return long.groupBy("column_name", "value", "index").agg(F.count(F.lit(1)).alias("count"))


@register("onehot_table", "SELECT index, (SELECT count(DISTINCT o_custkey) FROM orders) AS size, count(*) AS count FROM (SELECT "
          "CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS BIGINT) AS index, o_custkey FROM orders "
          "GROUP BY o_custkey) JOIN orders USING (o_custkey) GROUP BY index")
def q_onehot_table(spark, sf):
    """Sparse one-hot vectors of a column with many values: rows by their one slot."""
    df = _orders_text(spark, sf).select("o_custkey")
    indexed = M.index_by_table(df, ["o_custkey"], M.vocabulary_table(df, ["o_custkey"]))
    coded = M.onehot_stage(["o_custkey"]).fit(indexed).transform(indexed)
    slot = F.get(unwrap_udt("o_custkey_ohe")["indices"], 0).cast("long")
    size = unwrap_udt("o_custkey_ohe")["size"].cast("long")
    return coded.groupBy(slot.alias("index"), size.alias("size")).agg(F.count(F.lit(1)).alias("count"))
