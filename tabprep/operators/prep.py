"""ML preparation (M01-M13): MLlib stages for the pipelines, plus column forms
of the same transformations that SQL can check.

Fitting a stage collects only its parameters (label lists, medians, means,
standard deviations) -- bounded by the number of columns or categories --
never rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import rank as R
from tabprep.operators.partitioning import materialize
from tabprep.operators.schema import standardize_name


# ------------------------------------------------------------------ M01-M02
def label_stage(label: str = K.LABEL_COLUMN, output: str = "label") -> StringIndexer:
    """Alphabetical label index (``<=80k`` -> 0, ``>80k`` -> 1); invalid rows skipped."""
    return StringIndexer(inputCol=label, outputCol=output, handleInvalid="skip", stringOrderType="alphabetAsc")


def category_stages(cols) -> list:
    """Frequency-descending index per column (ties alphabetical); unseen -> n.

    One multi-column indexer: all vocabularies are counted in a single pass."""
    cols = list(cols)
    return [StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], handleInvalid="keep")]


def vocabulary_table(df: DataFrame, cols) -> DataFrame:
    """``column_name, value, count, index`` of every category, written: the same
    indices as :func:`category_stages`, for columns whose values are too many for
    a list on the driver.

    Values are counted with map-side combine and sorted by range; each row is
    written with the number of its range, so an index is the rows of earlier
    ranges plus the place inside its own.  NULL is no category."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])))
    counts = long.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    ranges = materialize(counts.orderBy("column_name", F.desc("count"), "value").select(
        "*", F.lit(1).cast("long").alias("one"), F.spark_partition_id().alias("_bucket")))
    placed = R.exclusive_prefix(ranges, [F.desc("count"), F.col("value")], ["one"], ["column_name"], with_total=False)
    return materialize(placed.select("column_name", "value", "count", F.col("one_before").cast("double").alias("index")))


def index_by_table(df: DataFrame, cols, vocabulary: DataFrame, suffix: str = "_idx") -> DataFrame:
    """``df`` with the index of each column's value from a vocabulary table; a
    value that the table lacks, or NULL, gets the number of its categories.

    One equi-join per column: Catalyst broadcasts a small vocabulary by its size
    and shuffles a large one, where adaptive execution splits hot values."""
    cols = list(cols)
    sizes = {r["column_name"]: r["n"] for r in vocabulary.where(F.col("column_name").isin(*cols))
             .groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    out = df
    for i, c in enumerate(cols):
        known = vocabulary.where(F.col("column_name") == c).select(F.col("value").alias(f"_value{i}"), F.col("index").alias(f"_index{i}"))
        out = out.join(known, F.col(c).cast("string") == F.col(f"_value{i}"), "left").drop(f"_value{i}").withColumn(
            f"{c}{suffix}", F.coalesce(f"_index{i}", F.lit(float(sizes.get(c, 0))))).drop(f"_index{i}")
    return out


# ------------------------------------------------------------------ M03-M04
def imputer_stage(cols=K.NUMERIC_FEATURES) -> Imputer:
    """Approximate median imputation (lower median)."""
    return Imputer(inputCols=list(cols), outputCols=[f"{c}_imputed" for c in cols], strategy="median")


def exact_medians(df: DataFrame, cols) -> dict:
    """Exact (midpoint) medians per column: distributed exact quantiles, one
    bounded row per column collected as the fitted parameters."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])))
    q = R.exact_quantiles(long, "value", [0.5], groups=["column_name"], names=["median"])
    return {r["column_name"]: r["median"] for r in q.collect()}


def impute_exact(df: DataFrame, cols, medians: dict | None = None, suffix: str = "") -> DataFrame:
    medians = medians if medians is not None else exact_medians(df, cols)
    return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)))
                           for c in cols})


# ------------------------------------------------------------------ M05-M06
def onehot_stage(cols) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                         handleInvalid="keep")


#: Distinct values of one column that one-hot encoding takes on.
MAX_CATEGORIES = 1000


class CardinalityError(ValueError):
    pass


def fit_vocabulary(df: DataFrame, cols, missing: str = "unknown", max_categories: int = MAX_CATEGORIES) -> dict:
    """Sorted distinct values per column (the one-hot vocabulary).  The values
    are counted first; a column with more than ``max_categories`` is an error,
    never a shortened list."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(missing)).alias("value")) for c in cols])))
    values = materialize(long.distinct())
    for r in values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per column
        if r["n"] > max_categories:
            raise CardinalityError(f"{r['column_name']} has {r['n']} values, more than {max_categories}")
    vocab: dict = {c: [] for c in cols}
    for r in values.orderBy("column_name", "value").collect():
        vocab[r["column_name"]].append(r["value"])
    return vocab


def indicator_names(col: str, values) -> list[str]:
    """``<col>__<value>`` per value; a value whose name is taken gets the
    first free number, in the order of the values."""
    names: list[str] = []
    for value in values:
        plain = name = f"{col}__{standardize_name(value)}"
        number = 2
        while name in names:
            name, number = f"{plain}__{number}", number + 1
        names.append(name)
    return names


def onehot_ignore(df: DataFrame, cols, vocab: dict | None = None, missing: str = "unknown", keep=()) -> DataFrame:
    """Indicator columns per value; unseen values -> all zeros."""
    vocab = vocab if vocab is not None else fit_vocabulary(df, cols, missing)
    ind = []
    for c in cols:
        x = F.coalesce(F.col(c), F.lit(missing))
        ind += [(x == F.lit(v)).cast("int").alias(name) for v, name in zip(vocab[c], indicator_names(c, vocab[c]))]
    return df.select(*keep, *ind)


# ------------------------------------------------------------------ M07-M09
def scaler_stage(input_col: str, output_col: str, with_mean: bool = True) -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=True)


def fit_moments(df: DataFrame, cols) -> dict:
    """mean, sample std and population std per column (one aggregate, one row)."""
    row = df.agg(*[e for c in cols for e in (
        F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"), F.stddev_pop(c).alias(f"p_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"], row[f"p_{c}"]) for c in cols}


def standardize(df: DataFrame, cols, with_mean: bool = True, population: bool = False, moments: dict | None = None,
                suffix: str = "_scaled", digits: int | None = None) -> DataFrame:
    """``(x - mean) / std`` (M07), ``x / std`` (M08) or sklearn's population std.
    A zero std leaves the value unscaled, as the MLlib scaler does."""
    moments = moments or fit_moments(df, cols)
    out = {}
    for c in cols:
        mean, samp, pop = moments[c]
        std = pop if population else samp
        x = F.col(c).cast("double")
        if with_mean:
            x = x - F.lit(mean)
        if std:
            x = x / F.lit(std)
        out[f"{c}{suffix}"] = F.round(x, digits) if digits is not None else x
    return df.withColumns(out)


# ------------------------------------------------------------------ M10-M12
def full_assembler(num_cols, cat_cols, with_mean: bool = True) -> list:
    """Imputed numerics -> vector -> scaled; features = scaled (+) one-hots."""
    return [
        VectorAssembler(inputCols=[f"{c}_imputed" for c in num_cols], outputCol="numeric_features"),
        scaler_stage("numeric_features", "scaled_numeric_features", with_mean),
        VectorAssembler(inputCols=["scaled_numeric_features"] + [f"{c}_ohe" for c in cat_cols],
                        outputCol="features"),
    ]


def compact_assembler(num_cols, cat_cols, scale: bool = False) -> list:
    """Imputed (optionally std-scaled) numerics (+) raw category indices (no one-hot)."""
    if scale:
        return [
            VectorAssembler(inputCols=[f"{c}_imputed" for c in num_cols], outputCol="numeric_vector"),
            scaler_stage("numeric_vector", "scaled_numeric_vector", with_mean=False),
            VectorAssembler(inputCols=["scaled_numeric_vector"] + [f"{c}_idx" for c in cat_cols],
                            outputCol="features"),
        ]
    return [VectorAssembler(inputCols=[f"{c}_imputed" for c in num_cols] + [f"{c}_idx" for c in cat_cols],
                            outputCol="features")]


def prep_stages(feature_set: str = "full", layout: str = "onehot", with_mean: bool = True,
                scale_compact: bool = False) -> list:
    """The preparation stage list: label index, imputer, category indexers,
    then either one-hot + scaled assembly or the compact index assembly."""
    cats = K.FEATURE_SETS[feature_set]
    stages = [label_stage(), imputer_stage(K.NUMERIC_FEATURES)] + category_stages(cats)
    if layout == "onehot":
        stages += [onehot_stage(cats)] + full_assembler(K.NUMERIC_FEATURES, cats, with_mean)
    else:
        stages += compact_assembler(K.NUMERIC_FEATURES, cats, scale_compact)
    return stages


def build_pipeline(prep: list, estimator=None) -> Pipeline:
    return Pipeline(stages=list(prep) + ([estimator] if estimator is not None else []))


# ------------------------------------------------------------------------ M13
def class_weights(df: DataFrame, label: str = K.LABEL_COLUMN, out: str = "class_weight") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` joined back by label.

    The weights, one row per class, are broadcast: a join by label would shuffle
    each class whole into one task."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    w = counts.withColumn("_tot", F.sum("_n_c").over(_whole())).withColumn("_k", F.count(F.lit(1)).over(_whole()))
    w = w.select(label, (F.col("_tot") / (F.col("_k") * F.col("_n_c"))).alias(out))
    return df.join(F.broadcast(w), on=label, how="left")


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy()
