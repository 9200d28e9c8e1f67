"""Registered queries: predicates, gates, DQ counts and the DQ metric table
(F01-F07, A01-A14), de-duplication and splits (D01-D09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import dedup as D
from tabprep.operators import quality as Q
from tabprep.plans.curate import run_curate
from tabprep.registry import (AUDIT, AUDIT_CUR, CORE, CORE_CUR, FIXED_NOW, KEEP, SOURCE_PATH, cleaned, curated,
                              ntz, raw, register, with_ctes)
from tabprep.sources import oracle_sql as O
from tabprep.sources import oracle_values as V

RAW_ONLY = with_ctes()
CONTRACT = ", ".join(K.CONTRACT_COLUMNS)


def _count_if(cond: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) AS {name}"


# ---------------------------------------------------------------------- A01
@register("row_count", RAW_ONLY + "SELECT count(*) AS row_count FROM raw")
def q_row_count(spark, sf):
    return Q.row_count(raw(spark, sf))


# ------------------------------------------------------------------- A02-A04
@register("raw_null_counts", RAW_ONLY + "SELECT " + ", ".join(_count_if(
    f"{c} IS NULL OR trim({c}) IN ({O.in_list(V.RAW_NULL_TOKENS)})", c) for c in K.CONTRACT_COLUMNS) + " FROM raw")
def q_raw_null_counts(spark, sf):
    return Q.raw_null_counts(raw(spark, sf), K.CONTRACT_COLUMNS)


@register("raw_blank_counts", RAW_ONLY + "SELECT " + ", ".join(_count_if(
    f"{c} IS NULL OR trim({c}) = ''", c) for c in K.CONTRACT_COLUMNS) + " FROM raw")
def q_raw_blank_counts(spark, sf):
    return Q.raw_null_counts(raw(spark, sf), K.CONTRACT_COLUMNS, tokens=("",))


CUR_COLS = K.CURATED_COLUMNS + ["processed_at"]


@register("null_counts", CORE_CUR + "SELECT " + ", ".join(_count_if(f"{c} IS NULL", c) for c in CUR_COLS)
          + " FROM curated")
def q_null_counts(spark, sf):
    return Q.null_counts(curated(spark, sf))


# ---------------------------------------------------------------------- A05
@register("null_metrics_long", CORE_CUR + " UNION ALL ".join(
    f"SELECT 'null_count__{c}' AS metric_name, count(*) FILTER (WHERE {c} IS NULL) AS metric_value FROM curated"
    for c in CUR_COLS))
def q_null_metrics_long(spark, sf):
    return Q.null_metrics_long(curated(spark, sf))


# ------------------------------------------------------------------- A06-A07
@register("label_distribution", CORE + "SELECT income, count(*) AS count FROM clean GROUP BY income")
def q_label_distribution(spark, sf):
    return Q.label_distribution(cleaned(spark, sf))


@register("distinct_labels", AUDIT_CUR + "SELECT DISTINCT income_label FROM curated_a")
def q_distinct_labels(spark, sf):
    return Q.distinct_labels(curated(spark, sf, audit=True), "income_label")


# ------------------------------------------------------------------- A08/D01
@register("duplicate_count", RAW_ONLY + (
    "SELECT (SELECT count(*) FROM raw) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT "
    + CONTRACT + " FROM raw)) AS distinct_count, (SELECT count(*) FROM raw) - (SELECT count(*) FROM "
    "(SELECT DISTINCT " + CONTRACT + " FROM raw)) AS duplicate_count"))
def q_duplicate_count(spark, sf):
    return Q.duplicate_count(raw(spark, sf), K.CONTRACT_COLUMNS)


@register("dedup_rows", RAW_ONLY + f"SELECT DISTINCT {CONTRACT} FROM raw")
def q_dedup_rows(spark, sf):
    return D.dedup_rows(raw(spark, sf), K.CONTRACT_COLUMNS)


# ------------------------------------------------------------------- A09/D03
KEY = ", ".join(K.BUSINESS_KEY)


@register("dedup_impact", CORE + (
    f"SELECT b AS before_dedup_count, a AS after_dedup_count, b - a AS business_key_duplicate_count FROM "
    f"(SELECT count(*) AS b FROM clean), (SELECT count(*) AS a FROM (SELECT DISTINCT {KEY} FROM clean))"))
def q_dedup_impact(spark, sf):
    return Q.dedup_impact(cleaned(spark, sf))


# ------------------------------------------------------------------- D02 keys
@register("dedup_by_key", CORE + (
    f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} "
    f"ORDER BY record_id, copy_no) AS _rn FROM clean) WHERE _rn = 1"))
def q_dedup_by_key(spark, sf):
    return ntz(D.dedup_by_key(cleaned(spark, sf), K.BUSINESS_KEY, tie_break=KEEP))


# ---------------------------------------------------------------------- F01
@register("error_token_rows", RAW_ONLY + f"SELECT record_id, copy_no FROM raw WHERE {O.any_error(K.CONTRACT_COLUMNS)}")
def q_error_token_rows(spark, sf):
    return Q.error_token_rows(raw(spark, sf), K.CONTRACT_COLUMNS).select(*KEEP)


# ---------------------------------------------------------------------- F02
@register("valid_label_rows", CORE + "SELECT record_id, copy_no, income FROM clean WHERE income IN ('<=80k', '>80k')")
def q_valid_label(spark, sf):
    return Q.valid_label(cleaned(spark, sf)).select(*KEEP, "income")


# ---------------------------------------------------------------------- F03
@register("range_violations", CORE_CUR + (
    "SELECT * FROM curated WHERE (age < 0 OR age > 120) OR (hours_per_week < 0 OR hours_per_week > 168)"))
def q_range_violations(spark, sf):
    return ntz(Q.range_violations(curated(spark, sf)))


# ---------------------------------------------------------------------- F04
@register("parse_failures", CORE + (
    "SELECT record_id, copy_no, event_time, income_raw, age_raw, "
    "CAST(event_time IS NOT NULL AND event_time_std IS NULL AS INTEGER) AS time_failed, "
    "CAST(income_raw IS NOT NULL AND income IS NULL AS INTEGER) AS label_failed, "
    "CAST(age_raw IS NOT NULL AND age IS NULL AS INTEGER) AS age_failed FROM clean "
    "WHERE (event_time IS NOT NULL AND event_time_std IS NULL) OR (income_raw IS NOT NULL AND income IS NULL) "
    "OR (age_raw IS NOT NULL AND age IS NULL)"))
def q_parse_failures(spark, sf):
    c = cleaned(spark, sf)
    t, lab, age = Q.parse_failed("event_time", "event_time_std"), Q.parse_failed("income_raw", "income"), \
        Q.parse_failed("age_raw", "age")
    return c.filter(t | lab | age).select(*KEEP, "event_time", "income_raw", "age_raw",
                                          t.cast("int").alias("time_failed"), lab.cast("int").alias("label_failed"),
                                          age.cast("int").alias("age_failed"))


# ------------------------------------------------------------------- F05/A10
def _cast_fail_sql(cte: str, count_errors: bool, pattern: str) -> str:
    parts = []
    for c in K.NUMERIC_CLEAN_COLUMNS:
        r = f"lower(trim({c}_raw))"
        cond = f"{r} IS NOT NULL AND {r} <> '' AND {c} IS NULL"
        if not count_errors:
            cond += f" AND NOT regexp_matches({r}, '{pattern}')"
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS cast_failure_count FROM {cte}")
    return " UNION ALL ".join(parts)


@register("cast_failure_table", CORE + _cast_fail_sql("clean", False, V.ERROR_TOKEN_PATTERN))
def q_cast_failure_table(spark, sf):
    return Q.cast_failure_table(cleaned(spark, sf))


@register("cast_failure_table_audit", AUDIT + _cast_fail_sql("clean_a", True, V.ERROR_TOKEN_PATTERN_PIPE))
def q_cast_failure_table_audit(spark, sf):
    return Q.cast_failure_table(cleaned(spark, sf, "audit"), count_errors=True)


# ---------------------------------------------------------------------- F07
LABEL_KEY = "lower(regexp_replace(trim(income), '\\s+', '', 'g'))"


@register("label_drift", RAW_ONLY + (
    f"SELECT {LABEL_KEY} AS income, count(*) AS drift_count FROM raw WHERE {LABEL_KEY} IS NOT NULL "
    f"AND {LABEL_KEY} NOT IN ('<=80k', '>80k') GROUP BY 1"))
def q_label_drift(spark, sf):
    r = raw(spark, sf)
    key = F.lower(F.regexp_replace(F.trim("income"), "\\s+", "")).alias("income")
    return Q.label_drift(r.select(key))


# ---------------------------------------------------------------------- A14
@register("time_failures", CORE + (
    "SELECT count(*) FILTER (WHERE event_time IS NOT NULL AND event_time_std IS NULL) AS raw_present_failures, "
    "count(*) FILTER (WHERE event_time_std IS NULL) AS null_timestamps FROM clean"))
def q_time_failures(spark, sf):
    return cleaned(spark, sf).agg(Q.time_failure_count("raw_present").alias("raw_present_failures"),
                                  Q.time_failure_count("null").alias("null_timestamps"))


# ---------------------------------------------------------------------- F06
GATE_SQL = CORE_CUR + (
    "SELECT gate, observed, observed = 0 AS passed FROM ("
    "SELECT 'missing_columns' AS gate, CAST(0 AS BIGINT) AS observed "
    "UNION ALL SELECT 'label_drift', count(*) FILTER (WHERE income IS NOT NULL AND income NOT IN ('<=80k', '>80k')) FROM curated "
    "UNION ALL SELECT 'empty_result', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM curated "
    "UNION ALL SELECT 'invalid_age', count(*) FILTER (WHERE age < 0 OR age > 120) FROM curated "
    "UNION ALL SELECT 'invalid_hours_per_week', count(*) FILTER (WHERE hours_per_week < 0 OR hours_per_week > 168) FROM curated "
    "UNION ALL SELECT 'numeric_cast_failures', CAST(sum(cast_failure_count) AS BIGINT) FROM ("
    + _cast_fail_sql("clean", False, V.ERROR_TOKEN_PATTERN) + "))")


@register("gate_report", GATE_SQL)
def q_gate_report(spark, sf):
    return Q.gate_report(curated(spark, sf), numeric_failures=Q.cast_failure_table(cleaned(spark, sf)))


# ---------------------------------------------------------------------- A13
def _dq_core_sql() -> str:
    err = O.any_error(["record_id", "copy_no"] + K.CONTRACT_COLUMNS)
    scalars = {
        "raw_row_count": "(SELECT count(*) FROM raw)",
        "curated_row_count": "(SELECT count(*) FROM curated)",
        "raw_duplicate_count": f"(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT {CONTRACT} FROM raw))",
        "business_key_duplicate_count": "(SELECT count(*) FROM clean) - (SELECT count(*) FROM curated)",
        "invalid_token_count": f"(SELECT count(*) FROM raw WHERE {err})",
        "invalid_age_count": "(SELECT count(*) FROM curated WHERE age < 0 OR age > 120)",
        "invalid_hours_per_week_count": "(SELECT count(*) FROM curated WHERE hours_per_week < 0 OR hours_per_week > 168)",
        "timestamp_parse_failure_count": "(SELECT count(*) FROM clean WHERE event_time IS NOT NULL AND event_time_std IS NULL)",
        "label_drift_count": "(SELECT count(*) FROM clean WHERE income IS NOT NULL AND income NOT IN ('<=80k', '>80k'))",
        "label_normalization_failure_count": "(SELECT count(*) FROM clean WHERE income_raw IS NOT NULL AND income IS NULL)",
        "numeric_cast_failure_count": "(SELECT CAST(sum(cast_failure_count) AS BIGINT) FROM ("
                                      + _cast_fail_sql("clean", False, V.ERROR_TOKEN_PATTERN) + "))",
    }
    scalars["invalid_record_count"] = " + ".join(scalars[k] for k in (
        "invalid_token_count", "invalid_age_count", "invalid_hours_per_week_count",
        "label_normalization_failure_count", "timestamp_parse_failure_count"))
    rows = [f"SELECT '{k}' AS metric_name, CAST({v} AS BIGINT) AS metric_value" for k, v in scalars.items()]
    rows += [f"SELECT 'null_count__{c}', CAST((SELECT count(*) FROM curated WHERE {c} IS NULL) AS BIGINT)" for c in CUR_COLS]
    return (CORE_CUR + f"SELECT metric_name, metric_value, '{SOURCE_PATH}' AS source_path, "
            f"TIMESTAMP '{FIXED_NOW}' AS measured_at FROM (" + " UNION ALL ".join(rows) + ") ORDER BY metric_name")


@register("dq_metrics_core", _dq_core_sql())
def q_dq_metrics_core(spark, sf):
    return ntz(Q.dq_metrics(raw(spark, sf), curated(spark, sf), "core", SOURCE_PATH, FIXED_NOW))


@register("curate_job_metrics", _dq_core_sql())
def q_curate_job_metrics(spark, sf):
    """The metric table of the whole job, from its staged rows."""
    return ntz(run_curate(raw(spark, sf), tie_break=KEEP, source_path=SOURCE_PATH, now=FIXED_NOW, enforce_gates=False).dq_metrics)


AUD_COLS = K.AUDIT_COLUMNS + ["processed_at", "pipeline_version"]


def _dq_audit_sql() -> str:
    trimmed = ", ".join(f"{O.trim_to_null(c, ())} AS {c}" for c in K.CONTRACT_COLUMNS)
    err = O.any_error(K.CONTRACT_COLUMNS, V.ERROR_TOKEN_PATTERN_PIPE)
    scalars = {
        "raw_row_count": "(SELECT count(*) FROM raw)",
        "curated_row_count": "(SELECT count(*) FROM curated_a)",
        "raw_duplicate_count": f"(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT {trimmed} FROM raw))",
        "business_key_duplicate_count": "(SELECT count(*) FROM clean_a) - (SELECT count(*) FROM curated_a)",
        "error_token_count": f"(SELECT count(*) FROM raw WHERE {err})",
        "timestamp_parse_failures": "(SELECT count(*) FROM clean_a WHERE event_time_raw IS NOT NULL AND event_time_std IS NULL)",
        "label_failures": "(SELECT count(*) FROM clean_a WHERE income_raw IS NOT NULL AND income_label IS NULL)",
        "age_cast_failures": "(SELECT count(*) FROM clean_a WHERE age_raw IS NOT NULL AND age IS NULL)",
        "numeric_cast_failure_count": "(SELECT CAST(sum(cast_failure_count) AS BIGINT) FROM ("
                                      + _cast_fail_sql("clean_a", True, V.ERROR_TOKEN_PATTERN_PIPE) + "))",
    }
    rows = [f"SELECT '{k}' AS metric_name, CAST({v} AS BIGINT) AS metric_value" for k, v in scalars.items()]
    rows += [f"SELECT 'null_count__{c}', CAST((SELECT count(*) FROM curated_a WHERE {c} IS NULL) AS BIGINT)"
             for c in AUD_COLS]
    return (AUDIT_CUR + f"SELECT metric_name, metric_value, TIMESTAMP '{FIXED_NOW}' AS measured_at, "
            f"'{SOURCE_PATH}' AS source_path FROM (" + " UNION ALL ".join(rows) + ") ORDER BY metric_name")


@register("dq_metrics_audit", _dq_audit_sql())
def q_dq_metrics_audit(spark, sf):
    return ntz(Q.dq_metrics(raw(spark, sf), curated(spark, sf, audit=True), "audit", SOURCE_PATH, FIXED_NOW))


# ------------------------------------------------------------------- D05/D06
@register("cap_rows", CORE_CUR + (
    "SELECT * FROM curated ORDER BY md5(concat_ws(chr(1), " + ", ".join(
        f"COALESCE(CAST({c} AS VARCHAR), chr(0))" for c in K.CURATED_COLUMNS + ["processed_at"])
    + ")) LIMIT 3000"))
def q_cap_rows(spark, sf):
    return ntz(D.cap_rows(curated(spark, sf), 3000))


# ------------------------------------------------------------------- D08/D09
HB = "CAST(('0x' || substr(md5(CAST(record_id AS VARCHAR) || '|' || CAST(copy_no AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


@register("hash_split", CORE + (
    f"SELECT record_id, copy_no, income, CASE WHEN {HB} < 80 THEN 'train' ELSE 'test' END AS split FROM clean"))
def q_hash_split(spark, sf):
    return D.hash_split(cleaned(spark, sf).select(*KEEP, "income"), KEEP)


@register("hash_split_counts", CORE + (
    f"SELECT CASE WHEN {HB} < 80 THEN 'train' ELSE 'test' END AS split, income, count(*) AS n FROM clean GROUP BY 1, 2"))
def q_hash_split_counts(spark, sf):
    s = D.hash_split(cleaned(spark, sf).select(*KEEP, "income"), KEEP)
    return s.groupBy("split", "income").agg(F.count(F.lit(1)).alias("n"))


SKEY = "md5(CAST(record_id AS VARCHAR) || '|' || CAST(copy_no AS VARCHAR))"
# stratified order: first 15 hex digits of md5(key), then md5 of the whole row
SORD = f"CAST(('0x' || substr({SKEY}, 1, 15)) AS BIGINT), md5(CAST(record_id AS VARCHAR) || '|' || CAST(copy_no AS VARCHAR) || '|' || income)"


@register("stratified_split", CORE + (
    "SELECT record_id, copy_no, income, CASE WHEN rn < round(cnt * 0.8) THEN 'train' ELSE 'test' END AS split "
    f"FROM (SELECT record_id, copy_no, income, row_number() OVER (PARTITION BY income ORDER BY {SORD}) - 1 AS rn, "
    "count(*) OVER (PARTITION BY income) AS cnt FROM clean WHERE income IS NOT NULL)"))
def q_stratified_split(spark, sf):
    c = cleaned(spark, sf).select(*KEEP, "income").where(F.col("income").isNotNull())
    return D.stratified_split(c, "income", key_cols=KEEP, test_fraction=0.2)


# ---------------------------------------------------------------------- D07
@register("random_split_counts")
def q_random_split_counts(spark, sf):
    """Native Bernoulli 80/20 split, seed 42 (partition-dependent, so rows-only)."""
    c = cleaned(spark, sf).select(*KEEP, "income")
    train, test = D.random_split(c, (0.8, 0.2), K.SEED)
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------------- D06
@register("top_k_capital_gain", CORE_CUR + (
    "SELECT * FROM curated ORDER BY capital_gain DESC NULLS LAST, " + ", ".join(
        f"{c} ASC NULLS FIRST" for c in K.CURATED_COLUMNS if c != "capital_gain") + " LIMIT 30"))
def q_top_k(spark, sf):
    cur = curated(spark, sf)
    tie = [c for c in K.CURATED_COLUMNS if c != "capital_gain"]
    return ntz(D.top_k(cur, "capital_gain", 30, tie=tie))
