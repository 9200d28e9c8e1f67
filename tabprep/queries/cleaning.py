"""Registered queries: schema operators (P01-P10), cleaners (C01-C16), preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.functions import clean as C
from tabprep.operators import dedup as D
from tabprep.operators import schema as S
from tabprep.registry import (AUDIT, AUDIT_CUR, CORE, CORE_CUR, KEEP, SERVICE, cleaned, curated,
                              ntz, raw, register, with_ctes)
from tabprep.sources import oracle_sql as O

CONTRACT = ", ".join(K.CONTRACT_COLUMNS)
RAW_ONLY = with_ctes()


# ------------------------------------------------------------------ C16 / P07
@register("clean_core", CORE + "SELECT * FROM clean")
def q_clean_core(spark, sf):
    return ntz(cleaned(spark, sf, "core"))


@register("clean_audit", AUDIT + "SELECT * FROM clean_a")
def q_clean_audit(spark, sf):
    return ntz(cleaned(spark, sf, "audit"))


@register("clean_service", SERVICE + "SELECT * FROM clean_s")
def q_clean_service(spark, sf):
    return ntz(cleaned(spark, sf, "service"))


# -------------------------------------------------------------- D02 + P08/P09
@register("curated_core", CORE_CUR + "SELECT * FROM curated")
def q_curated_core(spark, sf):
    return ntz(curated(spark, sf))


@register("curated_audit", AUDIT_CUR + "SELECT * FROM curated_a")
def q_curated_audit(spark, sf):
    return ntz(curated(spark, sf, audit=True))


# ------------------------------------------------------- single cleaners C01-C15
def _cleaner_sql(exprs: dict) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return RAW_ONLY + f"SELECT record_id, copy_no, {cols} FROM raw"


TEXT_COLS = ["age", "workclass", "education_level", "capital_loss", "race", "income"]


@register("trim_to_null_variants", _cleaner_sql({
    **{f"{c}_core": O.trim_to_null(c) for c in TEXT_COLS},
    **{f"{c}_blank": O.trim_to_null(c, ()) for c in TEXT_COLS},
    **{f"{c}_service": O.trim_to_null(c, K.NULL_TOKENS_SERVICE) for c in TEXT_COLS},
}))
def q_trim_to_null(spark, sf):
    r = raw(spark, sf)
    cols = [C.trim_to_null(c).alias(f"{c}_core") for c in TEXT_COLS]
    cols += [C.trim_to_null(c, ()).alias(f"{c}_blank") for c in TEXT_COLS]
    cols += [C.trim_to_null(c, K.NULL_TOKENS_SERVICE).alias(f"{c}_service") for c in TEXT_COLS]
    return r.select(*KEEP, *cols)


@register("clean_age_variants", _cleaner_sql({
    "age_core": O.clean_age("age"),
    "age_pipe": O.clean_age("age", pattern=K.ERROR_TOKEN_PATTERN_PIPE),
    "age_service": O.clean_age("age", reject_error=False),
}))
def q_clean_age(spark, sf):
    r = raw(spark, sf)
    return r.select(*KEEP, C.clean_age("age").alias("age_core"),
                    C.clean_age("age", error_pattern=K.ERROR_TOKEN_PATTERN_PIPE).alias("age_pipe"),
                    C.clean_age("age", reject_error=False).alias("age_service"))


NUM_COLS = ["education_num", "capital_gain", "capital_loss", "hours_per_week"]


@register("clean_numeric_variants", _cleaner_sql({
    **{f"{c}_strict": O.clean_numeric(c) for c in NUM_COLS},
    **{f"{c}_lenient": O.clean_numeric(c, strict=False, pattern=K.ERROR_TOKEN_PATTERN_PIPE) for c in NUM_COLS},
}))
def q_clean_numeric(spark, sf):
    r = raw(spark, sf)
    cols = [C.clean_numeric(c).alias(f"{c}_strict") for c in NUM_COLS]
    cols += [C.clean_numeric(c, strict=False, error_pattern=K.ERROR_TOKEN_PATTERN_PIPE).alias(f"{c}_lenient")
             for c in NUM_COLS]
    return r.select(*KEEP, *cols)


CAT_COLS = ["workclass", "education_level", "marital_status", "race", "sex", "native_country", "random_flag"]


@register("clean_category_and_default", _cleaner_sql({
    **{f"{c}_category": O.clean_category(c) for c in CAT_COLS},
    **{f"{c}_filled": f"COALESCE({O.trim_to_null(c)}, 'Unknown')" for c in CAT_COLS},
}))
def q_clean_category(spark, sf):
    r = raw(spark, sf)
    cols = [C.clean_category(c).alias(f"{c}_category") for c in CAT_COLS]
    cols += [C.fill_default(C.trim_to_null(c)).alias(f"{c}_filled") for c in CAT_COLS]
    return r.select(*KEEP, *cols)


@register("normalize_label_variants", _cleaner_sql({
    f"income_{v}": O.normalize_label("income", v) for v in ("core", "pipe", "service")
}))
def q_normalize_label(spark, sf):
    r = raw(spark, sf)
    return r.select(*KEEP, *[C.normalize_label("income", v).alias(f"income_{v}") for v in ("core", "pipe", "service")])


@register("parse_event_time_variants", _cleaner_sql({
    "ts_iso_first": O.parse_event_time("event_time", "iso_first"),
    "ts_formats_first": O.parse_event_time("event_time", "formats_first"),
    "ts_epoch_first": O.parse_event_time("event_time", "epoch_first"),
    "ts_epoch": "CAST(" + O.epoch_to_ts("trim(event_time)") + " AS TIMESTAMP)",
    "ts_epoch_ms": "CAST(" + O.epoch_to_ts("trim(event_time)", keep_millis=True) + " AS TIMESTAMP)",
}))
def q_parse_event_time(spark, sf):
    r = raw(spark, sf)
    return ntz(r.select(*KEEP,
                        C.parse_event_time("event_time", "iso_first").alias("ts_iso_first"),
                        C.parse_event_time("event_time", "formats_first").alias("ts_formats_first"),
                        C.parse_event_time("event_time", "epoch_first").alias("ts_epoch_first"),
                        C.epoch_to_ts("event_time").alias("ts_epoch"),
                        C.epoch_to_ts("event_time", keep_millis=True).alias("ts_epoch_ms")))


# ------------------------------------------------------------------- P01-P05
def _messy(name: str) -> str:
    return "  " + name.upper().replace("_", " - ") + " "


@register("standardize_columns", RAW_ONLY + f"SELECT record_id, copy_no, {CONTRACT} FROM raw")
def q_standardize_columns(spark, sf):
    r = raw(spark, sf)
    messy = r.toDF(*[_messy(c) if c in K.CONTRACT_COLUMNS else c for c in r.columns])
    return S.select_contract(S.standardize_columns(messy), keep=KEEP)


ALIASED = [("education_level" if c == "education_level" else c) for c in K.CONTRACT_COLUMNS]


@register("apply_aliases", RAW_ONLY + "SELECT record_id, copy_no, " + ", ".join(
    "event_time AS event_time_std" if c == "event_time" else c for c in K.CONTRACT_COLUMNS) + " FROM raw")
def q_apply_aliases(spark, sf):
    r = raw(spark, sf)
    renamed = r.withColumnsRenamed({"education_level": "Education", "event_time": "Event-Time",
                                    "hours_per_week": "hours-per-week", "native_country": "native-country"})
    out = S.apply_aliases(S.standardize_columns(renamed))
    cols = ["event_time_std" if c == "event_time" else c for c in K.CONTRACT_COLUMNS]
    return out.select(*KEEP, *cols)


@register("schema_contract", RAW_ONLY + (
    "SELECT count(*) AS row_count, CAST(19 AS INTEGER) AS column_count, '' AS missing_columns, "
    "'copy_no,record_id' AS extra_columns, '" + ",".join(K.CONTRACT_COLUMNS) + "' AS ordered_columns FROM raw"))
def q_schema_contract(spark, sf):
    rep = S.schema_contract(raw(spark, sf))
    return rep.select("row_count", "column_count",
                      *[F.array_join(c, ",").alias(c) for c in ("missing_columns", "extra_columns", "ordered_columns")])


@register("schema_contract_missing", RAW_ONLY + (
    "SELECT count(*) AS row_count, CAST(15 AS INTEGER) AS column_count, 'race,sex' AS missing_columns, "
    "'' AS extra_columns FROM raw"))
def q_schema_contract_missing(spark, sf):
    r = S.select_contract(raw(spark, sf)).drop("race", "sex")
    rep = S.schema_contract(r)
    return rep.select("row_count", "column_count",
                      *[F.array_join(c, ",").alias(c) for c in ("missing_columns", "extra_columns")])


@register("select_contract", RAW_ONLY + f"SELECT {CONTRACT} FROM raw")
def q_select_contract(spark, sf):
    return S.select_contract(raw(spark, sf))


@register("fill_missing_columns", RAW_ONLY + "SELECT record_id, copy_no, " + ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}" if c in ("random_flag", "source_system") else c for c in K.CONTRACT_COLUMNS)
    + ", CAST(NULL AS DOUBLE) AS weight FROM raw")
def q_fill_missing_columns(spark, sf):
    r = raw(spark, sf).drop("random_flag", "source_system")
    schema = {c: "string" for c in K.CONTRACT_COLUMNS}
    schema["weight"] = "double"
    return S.fill_missing_columns(r, schema).select(*KEEP, *K.CONTRACT_COLUMNS, "weight")


def _model_sql(cats):
    cols = ["income"] + K.NUMERIC_FEATURES + [f"COALESCE({c}, 'Unknown') AS {c}" for c in cats]
    return CORE_CUR + "SELECT " + ", ".join(cols) + " FROM curated WHERE income IN ('<=80k', '>80k')"


for _fs in ("full", "compact7", "compact6"):
    def _mk(fs):
        def q(spark, sf):
            return S.model_frame(curated(spark, sf), fs)
        return q
    register(f"model_frame_{_fs}", _model_sql(K.FEATURE_SETS[_fs]))(_mk(_fs))


# ------------------------------------------------------------------------ S11
@register("preview_clean", CORE + "SELECT * FROM clean ORDER BY record_id, copy_no LIMIT 20")
def q_preview(spark, sf):
    return ntz(D.preview(cleaned(spark, sf), 20, order_by=KEEP))
