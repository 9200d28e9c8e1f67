"""Predicates, data-quality counts, DQ metric table and gates.

Every count is a ``count_if`` inside one aggregate, so N metrics cost one
scan (partial + final hash aggregation) instead of N jobs.  Long-form tables
come from one wide aggregate + ``unpivot``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.functions.clean import any_error_token, trim_to_null
from tabprep.plans.clean import clean as clean_frame

# --------------------------------------------------------------------- helpers


def _long(wide: DataFrame, names, name_col="metric_name", value_col="metric_value") -> DataFrame:
    """Unpivot a one-row wide aggregate into (name, value) rows."""
    return wide.unpivot([], list(names), name_col, value_col)


def _wide_from_long(long: DataFrame, names, name_col="metric_name", value_col="metric_value") -> DataFrame:
    """One-row pivot of a small long table (conditional aggregation, no join)."""
    return long.agg(*[F.max(F.when(F.col(name_col) == n, F.col(value_col))).alias(n) for n in names])


# ------------------------------------------------------------------------ F01
def error_token_rows(df: DataFrame, cols=None, pattern: str = K.ERROR_TOKEN_PATTERN) -> DataFrame:
    cols = cols or df.columns
    return df.filter(any_error_token(cols, pattern))


# ------------------------------------------------------------------------ F02
def valid_label(df: DataFrame, label: str = K.LABEL_COLUMN, labels=K.LABELS) -> DataFrame:
    return df.filter(F.col(label).isin(*labels))


# ------------------------------------------------------------------------ F03
def out_of_range(c: str, lo, hi) -> Column:
    """Outside [lo, hi]; NULL is not a violation."""
    return F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))


def range_violations(df: DataFrame, bounds: dict | None = None) -> DataFrame:
    bounds = bounds or {"age": K.AGE_RANGE, "hours_per_week": K.HOURS_RANGE}
    cond = None
    for c, (lo, hi) in bounds.items():
        cond = out_of_range(c, lo, hi) if cond is None else cond | out_of_range(c, lo, hi)
    return df.filter(cond)


# ------------------------------------------------------------------------ F04
def parse_failed(raw: str, parsed: str) -> Column:
    return F.col(raw).isNotNull() & F.col(parsed).isNull()


def parse_failures(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    return df.filter(parse_failed(raw, parsed))


# ------------------------------------------------------------------------ F05
def cast_failed(c: str, count_errors: bool = False, raw_suffix: str = "_raw",
                pattern: str = K.ERROR_TOKEN_PATTERN) -> Column:
    """Raw text present (not blank) but the parsed value is NULL.

    Error tokens are excluded unless ``count_errors`` (audit profile)."""
    raw = F.lower(F.trim(F.col(f"{c}{raw_suffix}").cast("string")))
    cond = raw.isNotNull() & (raw != "") & F.col(c).isNull()
    if not count_errors:
        cond = cond & ~raw.rlike(pattern)
    return cond


def cast_failure_table(df: DataFrame, cols=K.NUMERIC_CLEAN_COLUMNS, count_errors: bool = False) -> DataFrame:
    """A10: (column_name, cast_failure_count) per numeric column from one aggregate."""
    wide = df.agg(*[F.count_if(cast_failed(c, count_errors)).alias(c) for c in cols])
    return _long(wide, cols, "column_name", "cast_failure_count")


def cast_failure_total(df: DataFrame, cols=K.NUMERIC_CLEAN_COLUMNS, count_errors: bool = False) -> Column:
    """Aggregate expression: total cast failures over ``cols``."""
    total = None
    for c in cols:
        e = F.count_if(cast_failed(c, count_errors))
        total = e if total is None else total + e
    return total


# ------------------------------------------------------------------------ F07
def label_drift(df: DataFrame, col: str = K.LABEL_COLUMN, allowed=K.LABELS) -> DataFrame:
    """Non-NULL values outside the allowed vocabulary, with their counts."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))
            .groupBy(col).agg(F.count(F.lit(1)).alias("drift_count")))


# --------------------------------------------------------------------- A01-A05
def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def raw_null_counts(df: DataFrame, cols=None, tokens=K.RAW_NULL_TOKENS) -> DataFrame:
    """Wide null count on raw text: NULL, or trimmed text in ``tokens`` (case-sensitive).

    ``tokens=("",)`` is the blank-or-NULL flavour (A03)."""
    cols = cols or df.columns
    return df.agg(*[
        F.count_if(F.col(c).isNull() | F.trim(F.col(c).cast("string")).isin(*tokens)).alias(c)
        for c in cols
    ])


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_metrics_long(df: DataFrame, cols=None, prefix: str = "null_count__") -> DataFrame:
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols])
    return _long(wide, [f"{prefix}{c}" for c in cols])


# --------------------------------------------------------------------- A06-A09
def label_distribution(df: DataFrame, label: str = K.LABEL_COLUMN) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def distinct_labels(df: DataFrame, label: str = K.LABEL_COLUMN) -> DataFrame:
    return df.select(label).distinct()


def _rows_and_distinct(df: DataFrame, cols) -> DataFrame:
    """``rows`` and ``distinct_rows`` from one scan: the distinct rows carry
    their counts (NULLs compare equal)."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"))


def duplicate_count(df: DataFrame, cols=None) -> DataFrame:
    """rows, distinct rows and exact duplicates."""
    return _rows_and_distinct(df, cols or df.columns).select(
        F.col("rows").alias("row_count"), F.col("distinct_rows").alias("distinct_count"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_count"))


def dedup_impact(df: DataFrame, keys=K.BUSINESS_KEY) -> DataFrame:
    """Before, after and removed counts for a business-key dedup."""
    return _rows_and_distinct(df, keys).select(
        F.col("rows").alias("before_dedup_count"), F.col("distinct_rows").alias("after_dedup_count"),
        (F.col("rows") - F.col("distinct_rows")).alias("business_key_duplicate_count"))


# ------------------------------------------------------------------------ A14
def time_failure_count(mode: str = "raw_present", raw: str = "event_time", parsed: str = "event_time_std") -> Column:
    """Aggregate expression. ``raw_present``: raw text present and parse NULL;
    ``null``: parse NULL regardless of input."""
    if mode == "raw_present":
        return F.count_if(parse_failed(raw, parsed))
    if mode == "null":
        return F.count_if(F.col(parsed).isNull())
    raise ValueError(mode)


# ------------------------------------------------------------------------ A13
# Metric names of the two metric tables (output contract).
CORE_METRICS = [
    "raw_row_count", "curated_row_count", "raw_duplicate_count", "business_key_duplicate_count",
    "invalid_token_count", "invalid_age_count", "invalid_hours_per_week_count", "invalid_record_count",
    "timestamp_parse_failure_count", "label_drift_count", "label_normalization_failure_count",
    "numeric_cast_failure_count",
]

AUDIT_METRICS = [
    "raw_row_count", "curated_row_count", "raw_duplicate_count", "business_key_duplicate_count",
    "error_token_count", "timestamp_parse_failures", "label_failures", "age_cast_failures",
    "numeric_cast_failure_count",
]


RAW_PREFIX = "_source_"


def dq_frame(raw: DataFrame, profile: str = "core", keep=(), contract=K.CONTRACT_COLUMNS) -> DataFrame:
    """Cleaned rows with what the raw-side metrics need besides: ``_err`` (a cell
    holds an error token) and the source's text of each contract column.  Written
    once, it serves the metrics, the gates and the dedup."""
    if profile == "audit":
        # the pipeline variant scans the contract columns and counts duplicates
        # on trimmed, blank-to-NULL text
        err = any_error_token(contract, K.ERROR_TOKEN_PATTERN_PIPE)
        source = [trim_to_null(c, K.NULL_TOKENS_PIPE).alias(RAW_PREFIX + c) for c in contract]
    else:
        err = any_error_token(raw.columns, K.ERROR_TOKEN_PATTERN)
        source = [F.col(c).alias(RAW_PREFIX + c) for c in contract]
    return clean_frame(raw, profile, keep=[*keep, err.alias("_err"), *source])


def dq_metrics(raw: DataFrame | None, curated: DataFrame, profile: str = "core", source_path: str = "",
               now: datetime | str | None = None, contract=K.CONTRACT_COLUMNS, cleaned: DataFrame | None = None) -> DataFrame:
    """The DQ metric table: scalar metrics + ``null_count__<col>`` per curated
    column, with ``source_path`` and ``measured_at``, ordered by name.

    Three aggregates do all the work: (1) one pass over the cleaned rows (row
    count, error tokens, parse/label/cast failures), (2) distinct source rows,
    (3) one pass over ``curated`` (row count, ranges, nulls).  They are unioned
    in long form and combined by conditional aggregation, so no join is needed.
    ``cleaned``: a written :func:`dq_frame`, else it is derived from ``raw``."""
    label = "income" if profile == "core" else "income_label"
    cleaned = cleaned if cleaned is not None else dq_frame(raw, profile, contract=contract)

    if profile == "core":
        a = cleaned.agg(
            F.count(F.lit(1)).alias("raw_row_count"),
            F.count_if("_err").alias("invalid_token_count"),
            time_failure_count("raw_present", "event_time", "event_time_std").alias("timestamp_parse_failure_count"),
            F.count_if(F.col(label).isNotNull() & ~F.col(label).isin(*K.LABELS)).alias("label_drift_count"),
            F.count_if(parse_failed("income_raw", label)).alias("label_normalization_failure_count"),
            cast_failure_total(cleaned, count_errors=False).alias("numeric_cast_failure_count"),
        )
        a_names = ["raw_row_count", "invalid_token_count", "timestamp_parse_failure_count",
                   "label_drift_count", "label_normalization_failure_count", "numeric_cast_failure_count"]
    else:
        a = cleaned.agg(
            F.count(F.lit(1)).alias("raw_row_count"),
            F.count_if("_err").alias("error_token_count"),
            time_failure_count("raw_present", "event_time_raw", "event_time_std").alias("timestamp_parse_failures"),
            F.count_if(parse_failed("income_raw", label)).alias("label_failures"),
            F.count_if(parse_failed("age_raw", "age")).alias("age_cast_failures"),
            cast_failure_total(cleaned, count_errors=True).alias("numeric_cast_failure_count"),
        )
        a_names = ["raw_row_count", "error_token_count", "timestamp_parse_failures", "label_failures",
                   "age_cast_failures", "numeric_cast_failure_count"]

    b = cleaned.select(*[RAW_PREFIX + c for c in contract]).distinct().agg(F.count(F.lit(1)).alias("_raw_distinct"))

    null_names = [f"null_count__{c}" for c in curated.columns]
    c_aggs = [F.count(F.lit(1)).alias("curated_row_count")]
    c_names = ["curated_row_count"]
    if profile == "core":
        c_aggs += [F.count_if(out_of_range("age", *K.AGE_RANGE)).alias("invalid_age_count"),
                   F.count_if(out_of_range("hours_per_week", *K.HOURS_RANGE)).alias("invalid_hours_per_week_count")]
        c_names += ["invalid_age_count", "invalid_hours_per_week_count"]
    c_aggs += [F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(curated.columns, null_names)]
    c = curated.agg(*c_aggs)

    long = (_long(a, a_names)
            .unionByName(_long(b, ["_raw_distinct"]))
            .unionByName(_long(c, c_names + null_names)))
    names = a_names + ["_raw_distinct"] + c_names + null_names
    w = _wide_from_long(long, names)
    derived = {
        "raw_duplicate_count": F.col("raw_row_count") - F.col("_raw_distinct"),
        "business_key_duplicate_count": F.col("raw_row_count") - F.col("curated_row_count"),
    }
    if profile == "core":
        derived["invalid_record_count"] = (
            F.col("invalid_token_count") + F.col("invalid_age_count") + F.col("invalid_hours_per_week_count")
            + F.col("label_normalization_failure_count") + F.col("timestamp_parse_failure_count"))
    w = w.withColumns(derived)
    metric_names = (CORE_METRICS if profile == "core" else AUDIT_METRICS) + null_names
    out = _long(w.select(*[F.col(n).cast("long").alias(n) for n in metric_names]), metric_names)
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    out = out.withColumns({"source_path": F.lit(source_path), "measured_at": stamp})
    if profile == "audit":
        out = out.select("metric_name", "metric_value", "measured_at", "source_path")
    return out.orderBy("metric_name")


# ------------------------------------------------------------------------ F06
def gate_report(curated: DataFrame, label: str = K.LABEL_COLUMN, numeric_failures: DataFrame | None = None,
                missing_columns=()) -> DataFrame:
    """(gate, observed, passed) for the fail-fast checks, from one aggregate over
    the curated frame plus the cast failures: a cast-failure table, or the rows
    of a metric table that hold them."""
    agg = curated.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(label).isNotNull() & ~F.col(label).isin(*K.LABELS)).alias("label_drift"),
        F.count_if(out_of_range("age", *K.AGE_RANGE)).alias("invalid_age"),
        F.count_if(out_of_range("hours_per_week", *K.HOURS_RANGE)).alias("invalid_hours"),
    )
    gates = agg.select(F.inline(F.array(
        F.struct(F.lit("missing_columns").alias("gate"), F.lit(len(missing_columns)).cast("long").alias("observed")),
        F.struct(F.lit("label_drift").alias("gate"), F.col("label_drift").cast("long").alias("observed")),
        F.struct(F.lit("empty_result").alias("gate"), F.when(F.col("row_count") == 0, 1).otherwise(0).cast("long").alias("observed")),
        F.struct(F.lit("invalid_age").alias("gate"), F.col("invalid_age").cast("long").alias("observed")),
        F.struct(F.lit("invalid_hours_per_week").alias("gate"), F.col("invalid_hours").cast("long").alias("observed")),
    )))
    if numeric_failures is not None:
        column = "metric_value" if "metric_value" in numeric_failures.columns else "cast_failure_count"
        nf = numeric_failures.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("observed"))
        gates = gates.unionByName(nf.select(F.lit("numeric_cast_failures").alias("gate"), "observed"))
    return gates.withColumn("passed", F.col("observed") == 0)


class GateError(ValueError):
    pass


def enforce(report: DataFrame, gates=None) -> None:
    """Raise :class:`GateError` when any (selected) gate failed.  The report is a
    handful of rows, so collecting it is bounded."""
    rows = report.collect()
    failed = [(r["gate"], r["observed"]) for r in rows if not r["passed"] and (gates is None or r["gate"] in gates)]
    if failed:
        raise GateError(f"Data-quality gates failed: {failed}")
