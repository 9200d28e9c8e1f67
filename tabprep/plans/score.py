"""Batch scoring of incoming records with a fitted pipeline.

records -> core cleaning -> model projection (categorical ``Unknown`` fill) ->
``PipelineModel.transform`` -> ``(model, prediction label, probability_gt_80k)``.
The positive class is found by label, and the numeric prediction is decoded
back to its label with ``IndexToString`` -- both from the fitted label indexer.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.functions import clean as C
from tabprep.plans.clean import clean


def label_indexer(model: PipelineModel) -> StringIndexerModel:
    for s in model.stages:
        if isinstance(s, StringIndexerModel) and s.isSet("outputCol") and s.getOutputCol() == "label":
            return s
    raise ValueError("pipeline has no label indexer")


def prepare_records(records: DataFrame, keep=()) -> DataFrame:
    """Contract-shaped cleaning of records whose fields may be missing; the
    label is not needed (the label indexer skips an absent input column)."""
    df = records
    if "event_time_std" in df.columns and "event_time" not in df.columns:
        df = df.withColumnRenamed("event_time_std", "event_time")
    missing = {c: F.lit(None).cast("string") for c in K.CONTRACT_COLUMNS if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    cleaned = clean(df.select(*keep, *[F.col(c).cast("string").alias(c) for c in K.CONTRACT_COLUMNS]),
                    "core", keep=list(keep))
    cats = [C.fill_default(c).alias(c) for c in K.CATEGORICAL_FEATURES]
    return cleaned.select(*keep, *K.NUMERIC_FEATURES, *cats)


def score(records: DataFrame, model: PipelineModel, model_name: str, keep=(), digits: int = 6) -> DataFrame:
    idx = label_indexer(model)
    labels = list(idx.labels)
    pos = labels.index(K.LABEL_HIGH)
    prepared = prepare_records(records, keep)
    # records carry no label: score with every stage except the label indexer
    scoring = PipelineModel(stages=[s for s in model.stages if s is not idx])
    pred = scoring.transform(prepared)
    decoded = IndexToString(inputCol="prediction", outputCol="_prediction_label", labels=labels).transform(pred)
    return decoded.select(
        *keep,
        F.lit(model_name).alias("model"),
        F.col("_prediction_label").alias("prediction"),
        F.round(vector_to_array("probability").getItem(pos), digits).alias("probability_gt_80k"),
    )
