"""Query registry: each entry is a Spark DataFrame builder ``fn(spark, sf_dir)``
plus (for SQL-expressible operators) the equivalent DuckDB SQL over the same
parquet tables.  ``__spark_entry__`` exposes both maps to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep import constants as K
from tabprep.operators import dedup as D
from tabprep.operators import schema as S
from tabprep.plans.clean import clean
from tabprep.session import apply_conf
from tabprep.sources import fixture
from tabprep.sources import oracle_sql as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Reproducible stamps and names used by the checked queries.
FIXED_NOW = "2024-01-01 00:00:00"
SOURCE_PATH = "fixture://raw"
PIPELINE_VERSION = "v1"
KEEP = ["record_id", "copy_no"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------- shared bits
def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as naive UTC wall clock (``timestamp_ntz``) for comparison."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    apply_conf(spark)
    return fixture.raw(spark, sf, spread_scan=True)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    apply_conf(spark)
    return fixture.table(spark, sf, name, spread_scan=True)


def cleaned(spark: SparkSession, sf: str, profile: str = "core") -> DataFrame:
    return clean(raw(spark, sf), profile, keep=KEEP)


def curated(spark: SparkSession, sf: str, audit: bool = False) -> DataFrame:
    """Business-key dedup (survivor: lowest record_id, copy_no) + publish projection."""
    c = cleaned(spark, sf, "audit" if audit else "core")
    keys = [("income_label" if k == "income" else k) for k in K.BUSINESS_KEY] if audit else K.BUSINESS_KEY
    survivors = D.dedup_by_key(c, keys, tie_break=KEEP)
    out = S.curated_projection(survivors, audit=audit)
    return S.with_lineage(out, now=FIXED_NOW, pipeline_version=PIPELINE_VERSION if audit else None)


RAW_CTE = fixture.duckdb_ctes("raw")
CLEAN_CORE_CTE = f"clean AS (SELECT record_id, copy_no,\n  {O.clean_core_select()}\nFROM raw)"
CLEAN_AUDIT_CTE = f"clean_a AS (SELECT record_id, copy_no,\n  {O.clean_audit_select()}\nFROM raw)"
CLEAN_SERVICE_CTE = f"clean_s AS (SELECT record_id, copy_no,\n  {O.clean_service_select()}\nFROM raw)"
KEY_LIST = ", ".join(K.BUSINESS_KEY)
AUDIT_KEY_LIST = ", ".join("income_label" if k == "income" else k for k in K.BUSINESS_KEY)
CURATED_CTE = (
    "curated AS (SELECT " + ", ".join(K.CURATED_COLUMNS)
    + f", TIMESTAMP '{FIXED_NOW}' AS processed_at FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY {KEY_LIST} ORDER BY record_id, copy_no) AS _rn FROM clean) WHERE _rn = 1)"
)
CURATED_AUDIT_CTE = (
    "curated_a AS (SELECT " + ", ".join(K.AUDIT_COLUMNS)
    + f", TIMESTAMP '{FIXED_NOW}' AS processed_at, '{PIPELINE_VERSION}' AS pipeline_version FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY {AUDIT_KEY_LIST} ORDER BY record_id, copy_no) AS _rn FROM clean_a) WHERE _rn = 1)"
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join((RAW_CTE,) + ctes) + "\n"


CORE = with_ctes(CLEAN_CORE_CTE)
CORE_CUR = with_ctes(CLEAN_CORE_CTE, CURATED_CTE)
AUDIT = with_ctes(CLEAN_AUDIT_CTE)
AUDIT_CUR = with_ctes(CLEAN_AUDIT_CTE, CURATED_AUDIT_CTE)
SERVICE = with_ctes(CLEAN_SERVICE_CTE)

# importing the query modules fills QUERIES / ORACLE
from tabprep.queries import cleaning, evaluation, features, jobs, ml, prep, profiling, quality  # noqa: E402,F401
