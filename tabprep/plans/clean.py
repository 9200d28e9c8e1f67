"""The full cleaning chain as one Project.

Three profiles reproduce the three cleaning dialects of the source jobs:

* ``core``    canonical batch job (null tokens null/none/nan, strict numerics,
               cascade A, core label vocabulary, ``Unknown`` workclass);
* ``audit``   pipeline variant (blank-only nulls, ``^error`` tokens, lenient
               numerics, cascade B, label published as ``income_label``, raw copies);
* ``service`` scoring-service normalisation (``?`` is null, lower-cased
               categories with ``unknown``, error-tolerant age, cascade C).

Each profile is one ``select`` of column expressions, so the whole chain
compiles to a single Project inside one whole-stage-codegen span, and the
scan is pruned to the columns actually used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.functions import clean as C

PROFILES = ("core", "audit", "service")


def clean(df: DataFrame, profile: str = "core", keep=()) -> DataFrame:
    """Clean a contract-shaped all-string frame; ``keep`` columns pass through first."""
    if profile == "core":
        return _clean_core(df, keep)
    if profile == "audit":
        return _clean_audit(df, keep)
    if profile == "service":
        return _clean_service(df, keep)
    raise ValueError(f"unknown profile {profile!r}; expected one of {PROFILES}")


def _clean_core(df: DataFrame, keep) -> DataFrame:
    t = {c: C.trim_to_null(c, K.NULL_TOKENS_CORE) for c in K.CONTRACT_COLUMNS}
    out = {c: t[c].alias(c) for c in K.CONTRACT_COLUMNS}
    out["age"] = C.clean_age(t["age"]).alias("age")
    out["workclass"] = C.fill_default(t["workclass"]).alias("workclass")
    out["income"] = C.normalize_label(t["income"], "core").alias("income")
    for c in K.NUMERIC_CLEAN_COLUMNS:
        out[c] = C.clean_numeric(t[c], strict=True).alias(c)
    extra = [
        C.parse_event_time(t["event_time"], "iso_first").alias("event_time_std"),
        t["age"].alias("age_raw"),
        t["income"].alias("income_raw"),
    ] + [t[c].alias(f"{c}_raw") for c in K.NUMERIC_CLEAN_COLUMNS]
    return df.select(*keep, *out.values(), *extra)


def _clean_audit(df: DataFrame, keep) -> DataFrame:
    t = {c: C.trim_to_null(c, K.NULL_TOKENS_PIPE) for c in K.CONTRACT_COLUMNS}
    out = {c: t[c].alias(c) for c in K.CONTRACT_COLUMNS}
    out["age"] = C.clean_age(t["age"], error_pattern=K.ERROR_TOKEN_PATTERN_PIPE).alias("age")
    out["workclass"] = C.fill_default(t["workclass"]).alias("workclass")
    for c in K.NUMERIC_CLEAN_COLUMNS:
        out[c] = C.clean_numeric(t[c], strict=False, error_pattern=K.ERROR_TOKEN_PATTERN_PIPE).alias(c)
    extra = [
        C.parse_event_time(t["event_time"], "formats_first").alias("event_time_std"),
        C.normalize_label(t["income"], "pipe").alias("income_label"),
        t["age"].alias("age_raw"),
        t["income"].alias("income_raw"),
        t["event_time"].alias("event_time_raw"),
    ] + [t[c].alias(f"{c}_raw") for c in K.NUMERIC_CLEAN_COLUMNS]
    return df.select(*keep, *out.values(), *extra)


def _clean_service(df: DataFrame, keep) -> DataFrame:
    """Numeric + categorical features + event_time_std (+ normalised income)."""
    tokens = K.NULL_TOKENS_SERVICE
    cols = []
    for c in K.NUMERIC_FEATURES:
        src = C.trim_to_null(c, tokens) if c in df.columns else F.lit(None).cast("string")
        if c == "age":
            cols.append(C.clean_age(src, reject_error=False).cast("double").alias(c))
        else:
            cols.append(C.clean_numeric(src, strict=True, error_pattern=K.ERROR_TOKEN_PATTERN_PIPE).alias(c))
    for c in K.CATEGORICAL_FEATURES:
        src = F.col(c) if c in df.columns else F.lit(None).cast("string")
        cols.append(C.clean_category(src, tokens).alias(c))
    time_src = "event_time_std" if "event_time_std" in df.columns else (
        "event_time" if "event_time" in df.columns else None)
    if time_src is None:
        cols.append(F.lit(None).cast("timestamp").alias("event_time_std"))
    else:
        cols.append(C.parse_event_time(C.trim_to_null(time_src, tokens), "epoch_first").alias("event_time_std"))
    if K.LABEL_COLUMN in df.columns:
        cols.append(C.normalize_label(C.trim_to_null(K.LABEL_COLUMN, tokens), "service").alias(K.LABEL_COLUMN))
    return df.select(*keep, *cols)
