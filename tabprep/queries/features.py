"""Registered queries: feature engineering."""

from __future__ import annotations

from tabprep import constants as K
from tabprep.functions import features as X
from tabprep.operators.features import build_features
from tabprep.registry import KEEP, SERVICE, cleaned, register, table
from tabprep.sources import oracle_sql as O
from tabprep.sources import oracle_values as V


def _bucket_sql(x, edges, labels):
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{x} > {lo}" if hi is None else f"{x} > {lo} AND {x} <= {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "(CASE " + " ".join(parts) + " ELSE 'unknown' END)"


def _time_sql(t):
    dow = f"(isodow({t}) - 1)"
    return {
        "event_year": f"CAST(year({t}) AS INTEGER)",
        "event_month": f"CAST(month({t}) AS INTEGER)",
        "event_dayofweek": f"CAST({dow} AS INTEGER)",
        "event_hour": f"CAST(hour({t}) AS INTEGER)",
        "event_quarter": f"CASE WHEN {t} IS NULL THEN 'unknown' ELSE 'q' || CAST(quarter({t}) AS VARCHAR) END",
        "event_is_weekend": f"CASE WHEN {t} IS NULL THEN 'unknown' WHEN {dow} >= 5 THEN 'yes' ELSE 'no' END",
    }


def _features_sql() -> str:
    g, lo = "COALESCE(capital_gain, 0.0)", "COALESCE(capital_loss, 0.0)"
    cols = {c: f"CAST({c} AS DOUBLE)" for c in K.NUMERIC_FEATURES}
    cols.update({c: O.clean_category(c) for c in K.CATEGORICAL_FEATURES})
    cols.update({
        "capital_net": f"{g} - {lo}", "capital_total": f"{g} + {lo}",
        "has_capital_gain": f"CAST({g} > 0 AS INTEGER)", "has_capital_loss": f"CAST({lo} > 0 AS INTEGER)",
        "capital_profile": f"CASE WHEN {g} > 0 AND {lo} > 0 THEN 'both' WHEN {g} > 0 THEN 'gain' "
                           f"WHEN {lo} > 0 THEN 'loss' ELSE 'none' END",
        "hours_x_education": "hours_per_week * education_num",
        "age_x_education": "age * education_num",
    })
    cols.update(_time_sql("event_time_std"))
    cols["age_bucket"] = _bucket_sql("age", *V.AGE_BUCKETS)
    cols["hours_bucket"] = _bucket_sql("hours_per_week", *V.HOURS_BUCKETS)
    cols["education_group"] = _bucket_sql("education_num", *V.EDUCATION_BUCKETS)
    m = f"COALESCE({O.clean_category('marital_status')}, '')"
    cols["marital_group"] = "(CASE " + " ".join(
        f"WHEN contains({m}, '{n}') THEN '{lab}'" for n, lab in V.MARITAL_GROUPS) + " ELSE 'unknown' END)"
    key = f"regexp_replace(lower({O.clean_category('native_country')}), '[^0-9a-z]+', '', 'g')"
    cols["is_us_native"] = f"CASE WHEN COALESCE({key} = 'unitedstates', false) THEN 'yes' ELSE 'no' END"
    order = K.MODEL_NUMERIC_FEATURES + K.MODEL_CATEGORICAL_FEATURES
    return SERVICE + "SELECT record_id, copy_no, " + ", ".join(f"{cols[c]} AS {c}" for c in order) + " FROM clean_s"


@register("build_features", _features_sql())
def q_build_features(spark, sf):
    return build_features(cleaned(spark, sf, "service"), keep=KEEP)


EV = "(SELECT event_id, ts FROM events)"


@register("time_features_events", "SELECT event_id, " + ", ".join(
    f"{e} AS {n}" for n, e in _time_sql("ts").items()) + " FROM events")
def q_time_features_events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", *[e.alias(n) for n, e in X.time_features("ts").items()])
