"""Schema and projection operators (contract check, renames, projections).

Column-name work happens on the driver over ``df.columns`` (metadata only);
every data-touching step is a single Project so Catalyst keeps one stage.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep import constants as K


class ContractError(ValueError):
    """Raised when a source misses contract columns."""


# ------------------------------------------------------------------------ P01
def standardize_name(name: str) -> str:
    """The name's ASCII letter and digit runs, lower-cased and joined by ``_``."""
    return "_".join(re.findall("[0-9a-z]+", str(name).lower()))


def standardize_columns(df: DataFrame, aliases: dict | None = None) -> DataFrame:
    """Rename every column to its standard form (one Project).

    ``aliases`` (P02) maps a standardised name onto a contract name, e.g.
    ``education`` -> ``education_level``."""
    aliases = aliases or {}
    names = [aliases.get(standardize_name(c), standardize_name(c)) for c in df.columns]
    return df.toDF(*names)


# ------------------------------------------------------------------------ P02
def apply_aliases(df: DataFrame, aliases: dict = K.FIELD_ALIASES) -> DataFrame:
    present = {k: v for k, v in aliases.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


# ------------------------------------------------------------------------ P03
def contract_diff(columns, expected=K.CONTRACT_COLUMNS):
    """Names the source lacks and names beyond the contract, each in order."""
    have, want = dict.fromkeys(columns), dict.fromkeys(expected)
    return sorted(n for n in want if n not in have), sorted(n for n in have if n not in want)


def _reject(missing) -> None:
    raise ContractError(f"the source lacks {len(missing)} contract column(s): {', '.join(missing)}")


def schema_contract(df: DataFrame, expected=K.CONTRACT_COLUMNS, raise_on_missing: bool = False) -> DataFrame:
    """One-row contract report: row_count, column_count, missing/extra/ordered column arrays.

    The row count is a distributed aggregate; the name lists are metadata."""
    missing, extra = contract_diff(df.columns, expected)
    if missing and raise_on_missing:
        _reject(missing)
    ordered = [c for c in expected if c in df.columns]

    def arr(values):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("int").alias("column_count"),
        arr(missing).alias("missing_columns"),
        arr(extra).alias("extra_columns"),
        arr(ordered).alias("ordered_columns"),
    )


def enforce_contract(df: DataFrame, expected=K.CONTRACT_COLUMNS) -> DataFrame:
    missing, _ = contract_diff(df.columns, expected)
    if missing:
        _reject(missing)
    return df


# ------------------------------------------------------------------------ P04
def select_contract(df: DataFrame, expected=K.CONTRACT_COLUMNS, keep=()) -> DataFrame:
    """Deterministic column order; extra columns are dropped (``keep`` excepted)."""
    enforce_contract(df, expected)
    return df.select(*keep, *expected)


# ------------------------------------------------------------------------ P05
def fill_missing_columns(df: DataFrame, schema: dict) -> DataFrame:
    """Add each absent column of ``schema`` ({name: type}) as a typed NULL."""
    absent = {c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


# ------------------------------------------------------------------------ P06
def column_metadata(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(column_name, data_type, nullable) from the schema (no data is read)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    schema = T.StructType([
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
    ])
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------------ P08
def curated_projection(df: DataFrame, audit: bool = False, keep=()) -> DataFrame:
    cols = K.AUDIT_COLUMNS if audit else K.CURATED_COLUMNS
    return df.select(*keep, *cols)


# ------------------------------------------------------------------------ P09
def with_lineage(df: DataFrame, now: datetime | str | None = None, pipeline_version: str | None = None,
                 source_path: str | None = None, measured: bool = False) -> DataFrame:
    """Add ``processed_at`` (or ``measured_at``) and optional version/source columns.

    ``now`` makes the stamp reproducible; by default ``current_timestamp()``."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    cols = {("measured_at" if measured else "processed_at"): stamp}
    if pipeline_version is not None:
        cols["pipeline_version"] = F.lit(pipeline_version)
    if source_path is not None:
        cols["source_path"] = F.lit(source_path)
    return df.withColumns(cols)


# ------------------------------------------------------------------------ P10
def model_frame(df: DataFrame, feature_set: str = "full", label: str = K.LABEL_COLUMN,
                fill_unknown: bool = True, valid_only: bool = True, keep=()) -> DataFrame:
    """label + 5 numeric + categorical features (full / compact7 / compact6).

    Applies the valid-label filter (F02) and the ``Unknown`` fill (C08) in the
    same Project/Filter, so the scan reads only these columns."""
    cats = K.FEATURE_SETS[feature_set]
    cols = [F.col(c) for c in (*keep, label, *K.NUMERIC_FEATURES)]
    cols += [F.coalesce(F.col(c), F.lit(K.UNKNOWN_CATEGORY)).alias(c) if fill_unknown else F.col(c) for c in cats]
    out = df.select(*cols)
    if valid_only:
        out = out.filter(F.col(label).isin(*K.LABELS))
    return out
