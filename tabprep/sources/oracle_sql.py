"""DuckDB text for the independent oracle queries.

These helpers write the *SQL* form of each operator so the driver can check
the Spark DataFrame result against DuckDB on the same parquet tables.  They
are not used by the Spark code path.  Dialect rules: ``regexp_replace`` needs
the ``'g'`` flag, integer sums are cast to BIGINT, epoch values go through
``make_timestamp`` on BIGINT micros, and the free timestamp parse is guarded
by ``^[0-9]{4}-`` (DuckDB accepts shapes Spark rejects).
"""

from __future__ import annotations

from tabprep import constants as K
from tabprep.sources import oracle_values as V


def lit(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(lit(v) for v in values)


def trim_to_null(c: str, tokens=V.NULL_TOKENS_CORE) -> str:
    t = f"trim(CAST({c} AS VARCHAR))"
    cond = f"{t} = ''"
    if tokens:
        cond += f" OR lower({t}) IN ({in_list(tokens)})"
    return f"(CASE WHEN {c} IS NULL OR {cond} THEN NULL ELSE {t} END)"


def clean_age(x: str, reject_error=True, pattern=V.ERROR_TOKEN_PATTERN) -> str:
    v = f"lower(trim({x}))"
    d = f"regexp_extract({v}, '([0-9]+)', 1)"
    bad = f"{v} IS NULL OR {v} = '' OR {d} = ''"
    if reject_error:
        bad += f" OR regexp_matches({v}, '{pattern}')"
    return f"(CASE WHEN {bad} THEN NULL ELSE TRY_CAST({d} AS INTEGER) END)"


def clean_numeric(x: str, strict=True, pattern=V.ERROR_TOKEN_PATTERN) -> str:
    v = f"lower(trim({x}))"
    nc = f"replace({v}, ',', '')"
    mult = f"(CASE WHEN regexp_matches({nc}, 'k$') THEN 1000.0 ELSE 1.0 END)"
    d = f"regexp_replace({nc}, '[^0-9.-]', '', 'g')"
    bad = f"{v} IS NULL OR {v} = '' OR regexp_matches({v}, '{pattern}')"
    if strict:
        bad += f" OR NOT regexp_matches({d}, '^-?[0-9]+(\\.[0-9]+)?$')"
    return f"(CASE WHEN {bad} THEN NULL ELSE CAST(TRY_CAST({d} AS DOUBLE) * {mult} AS DOUBLE) END)"


def normalize_label(x: str, vocab="core") -> str:
    key = f"lower(regexp_replace(trim({x}), '\\s+', '', 'g'))"
    parts = " ".join(f"WHEN {key} IN ({in_list(sp)}) THEN {lit(lab)}" for lab, sp in V.LABEL_VOCAB[vocab].items())
    return f"(CASE {parts} ELSE NULL END)"


def clean_category(x: str, tokens=V.NULL_TOKENS_SERVICE) -> str:
    v = f"lower({trim_to_null(x, tokens)})"
    return f"(CASE WHEN {v} IS NULL OR starts_with({v}, 'error') THEN 'unknown' ELSE {v} END)"


_STRPTIME = {
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-dd": "%Y-%m-%d",
    "dd/MM/yy HH:mm": "%d/%m/%y %H:%M",
    "dd/MM/yy": "%d/%m/%y",
    "MM/dd/yy HH:mm": "%m/%d/%y %H:%M",
    "MM/dd/yy": "%m/%d/%y",
}


def _fmt(t: str, spark_fmt: str) -> str:
    return f"try_strptime({t}, '{_STRPTIME[spark_fmt]}')"


def epoch_to_ts(t: str, keep_millis=False) -> str:
    s = (f"CASE WHEN regexp_matches({t}, '^[0-9]{{10}}$') "
         f"THEN make_timestamp(CAST({t} AS BIGINT) * CAST(1000000 AS BIGINT)) END")
    if keep_millis:
        ms = (f"CASE WHEN regexp_matches({t}, '^[0-9]{{13}}$') "
              f"THEN make_timestamp(CAST({t} AS BIGINT) * CAST(1000 AS BIGINT)) END")
    else:
        ms = (f"CASE WHEN regexp_matches({t}, '^[0-9]{{13}}$') "
              f"THEN make_timestamp(CAST(floor(CAST({t} AS BIGINT) / 1000) AS BIGINT) * CAST(1000000 AS BIGINT)) END")
    return f"COALESCE({s}, {ms})"


def _default_parse(t: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-') THEN TRY_CAST({t} AS TIMESTAMP) END"


def parse_event_time(x: str, order="iso_first") -> str:
    t = f"trim({x})"
    if order == "iso_first":
        parts = [_default_parse(t), epoch_to_ts(t)] + [_fmt(t, f) for f in V.DAY_FIRST_FORMATS + V.MONTH_FIRST_FORMATS]
    elif order == "formats_first":
        parts = [_fmt(t, f) for f in V.ISO_FORMATS + V.DAY_FIRST_FORMATS + V.MONTH_FIRST_FORMATS] + [epoch_to_ts(t)]
    else:
        parts = [epoch_to_ts(t, keep_millis=True), _default_parse(t)]
        parts += [_fmt(t, f) for f in V.MONTH_FIRST_FORMATS + V.DAY_FIRST_FORMATS]
    return "CAST(COALESCE(" + ", ".join(parts) + ") AS TIMESTAMP)"


def any_error(cols, pattern=V.ERROR_TOKEN_PATTERN) -> str:
    return "(" + " OR ".join(
        f"COALESCE(regexp_matches(lower(trim(CAST({c} AS VARCHAR))), '{pattern}'), false)" for c in cols) + ")"


def clean_core_select() -> str:
    """Column list of the core profile over ``raw`` (as a CTE body)."""
    t = {c: trim_to_null(c) for c in K.CONTRACT_COLUMNS}
    cols = []
    for c in K.CONTRACT_COLUMNS:
        if c == "age":
            e = clean_age(t[c])
        elif c == "workclass":
            e = f"COALESCE({t[c]}, 'Unknown')"
        elif c == "income":
            e = normalize_label(t[c], "core")
        elif c in K.NUMERIC_CLEAN_COLUMNS:
            e = clean_numeric(t[c])
        else:
            e = t[c]
        cols.append(f"{e} AS {c}")
    cols.append(f"{parse_event_time(t['event_time'], 'iso_first')} AS event_time_std")
    cols.append(f"{t['age']} AS age_raw")
    cols.append(f"{t['income']} AS income_raw")
    cols += [f"{t[c]} AS {c}_raw" for c in K.NUMERIC_CLEAN_COLUMNS]
    return ",\n  ".join(cols)


def clean_audit_select() -> str:
    tok = V.NULL_TOKENS_PIPE
    p = V.ERROR_TOKEN_PATTERN_PIPE
    t = {c: trim_to_null(c, tok) for c in K.CONTRACT_COLUMNS}
    cols = []
    for c in K.CONTRACT_COLUMNS:
        if c == "age":
            e = clean_age(t[c], pattern=p)
        elif c == "workclass":
            e = f"COALESCE({t[c]}, 'Unknown')"
        elif c in K.NUMERIC_CLEAN_COLUMNS:
            e = clean_numeric(t[c], strict=False, pattern=p)
        else:
            e = t[c]
        cols.append(f"{e} AS {c}")
    cols.append(f"{parse_event_time(t['event_time'], 'formats_first')} AS event_time_std")
    cols.append(f"{normalize_label(t['income'], 'pipe')} AS income_label")
    cols.append(f"{t['age']} AS age_raw")
    cols.append(f"{t['income']} AS income_raw")
    cols.append(f"{t['event_time']} AS event_time_raw")
    cols += [f"{t[c]} AS {c}_raw" for c in K.NUMERIC_CLEAN_COLUMNS]
    return ",\n  ".join(cols)


def clean_service_select() -> str:
    tok = V.NULL_TOKENS_SERVICE
    cols = []
    for c in K.NUMERIC_FEATURES:
        src = trim_to_null(c, tok)
        if c == "age":
            cols.append(f"CAST({clean_age(src, reject_error=False)} AS DOUBLE) AS {c}")
        else:
            cols.append(f"{clean_numeric(src, pattern=V.ERROR_TOKEN_PATTERN_PIPE)} AS {c}")
    cols += [f"{clean_category(c, tok)} AS {c}" for c in K.CATEGORICAL_FEATURES]
    cols.append(f"{parse_event_time(trim_to_null('event_time', tok), 'epoch_first')} AS event_time_std")
    cols.append(f"{normalize_label(trim_to_null('income', tok), 'service')} AS income")
    return ",\n  ".join(cols)
