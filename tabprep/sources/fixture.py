"""SQL test fixtures derived from the supplied TPC-H-style tables.

The reference ships neither its dirty CSV nor tests, so the dirty table
``raw`` (17 all-string contract columns plus ``record_id, copy_no``) and the
scored table ``preds`` are defined as SQL over ``orders``, ``customer`` and
``nation``.  The same text runs unchanged in Spark and DuckDB; the DuckDB
oracle queries embed :data:`RAW_CTES` / :data:`PREDS_CTE` directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixture definition (kept textually identical for both engines).
RAW_CTES = """base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_totalprice AS tp,
         o.o_orderstatus AS st, o.o_orderpriority AS pr,
         CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS d,
         c.c_mktsegment AS seg, n.n_name AS nat,
         CAST(17 + (o.o_custkey * 7) % 74 AS STRING) AS a,
         CAST(1 + o.o_custkey % 16 AS STRING) AS e,
         0 AS copy_no
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
), dup AS (
  SELECT * FROM base
  UNION ALL
  SELECT k, ck, tp, st, pr, d, seg, nat, a, e, 1 AS copy_no FROM base WHERE k % 50 IN (0, 1)
), raw AS (
SELECT
  k AS record_id, copy_no,
  CASE WHEN k % 97 = 5 THEN '150' WHEN k % 20 = 0 THEN 'ERROR_AGE' WHEN k % 20 = 1 THEN ''
       WHEN k % 20 = 2 THEN 'null' WHEN k % 20 = 3 THEN ' ' || a || ' yrs' ELSE a END AS age,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN ' None ' ELSE '  ' || seg || ' ' END AS workclass,
  CASE WHEN k % 17 = 0 THEN ' ' ELSE 'level_' || e END AS education_level,
  CASE WHEN k % 5 = 0 THEN e || '.0' WHEN k % 5 = 1 THEN ' ' || e || ' ' ELSE e END AS education_num,
  CASE WHEN ck % 5 = 0 THEN 'Married-civ' WHEN ck % 5 = 1 THEN 'Never-worked' WHEN ck % 5 = 2 THEN 'Divorced'
       WHEN ck % 5 = 3 THEN 'Separated' ELSE 'Widowed' END AS marital_status,
  pr AS occupation,
  CASE WHEN ck % 3 = 0 THEN 'Husband' WHEN ck % 3 = 1 THEN 'Wife' ELSE 'Own-child' END AS relationship,
  CASE WHEN ck % 4 = 0 THEN 'White' WHEN ck % 4 = 1 THEN 'Black' WHEN ck % 4 = 2 THEN 'Asian' ELSE '?' END AS race,
  CASE WHEN ck % 2 = 0 THEN 'Male' ELSE ' Female' END AS sex,
  CASE WHEN k % 50 = 1 AND copy_no = 1 THEN '777'
       WHEN k % 10 = 0 THEN '$' || CAST(k % 99 AS STRING) || 'k'
       WHEN k % 10 = 1 THEN '$1,' || CAST(100 + k % 900 AS STRING)
       WHEN k % 10 = 2 THEN 'ERROR_GAIN' WHEN k % 10 = 3 THEN '' ELSE '0' END AS capital_gain,
  CASE WHEN k % 101 = 7 THEN '1-2' WHEN k % 7 = 0 THEN '-12.5' WHEN k % 7 = 1 THEN '5%' WHEN k % 7 = 2 THEN 'nan' ELSE '0' END AS capital_loss,
  CASE WHEN k % 40 = 0 THEN '200' ELSE CAST(1 + (k * 13) % 99 AS STRING) END AS hours_per_week,
  CASE WHEN k % 3 = 0 THEN 'United-States' ELSE ' ' || nat END AS native_country,
  CASE WHEN tp <= 80000 THEN
         CASE WHEN k % 6 = 0 THEN '=< 80K' WHEN k % 6 = 1 THEN ' LE80K ' WHEN k % 6 = 2 THEN 'low'
              WHEN k % 6 = 3 THEN '0' WHEN k % 6 = 4 THEN '<=50k' ELSE '<=80k' END
       ELSE
         CASE WHEN k % 6 = 0 THEN '> 80K' WHEN k % 6 = 1 THEN 'GT80K' WHEN k % 6 = 2 THEN 'high'
              WHEN k % 6 = 3 THEN '1' WHEN k % 6 = 4 THEN 'maybe' ELSE '>80k' END END AS income,
  CASE WHEN k % 9 = 0 THEN d || ' 10:20:30' WHEN k % 9 = 1 THEN d || 'T10:20:30' WHEN k % 9 = 2 THEN d
       WHEN k % 9 = 3 THEN CAST(1700000000 + (k % 1000) * 3600 AS STRING)
       WHEN k % 9 = 4 THEN CAST(1700000000 + (k % 1000) * 3600 AS STRING) || '123'
       WHEN k % 9 = 5 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/24'
       WHEN k % 9 = 6 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/24 09:15'
       WHEN k % 9 = 7 THEN substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/24'
       ELSE 'not a date' END AS event_time,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 2 = 0 THEN 'y' ELSE 'n' END AS random_flag,
  CASE WHEN st = 'F' THEN 'crm' WHEN st = 'O' THEN 'web' ELSE 'api' END AS source_system
FROM dup
)"""

PREDS_CTE = """preds AS (
SELECT k AS row_id, label, score,
       CASE WHEN score >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
       CASE WHEN k % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey AS k,
             CASE WHEN o_totalprice > 80000 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
             CAST((o_orderkey * 37) % 700 + CASE WHEN o_totalprice > 80000 THEN 300 ELSE 0 END AS DOUBLE)
               / CAST(1000 AS DOUBLE) AS score
      FROM {orders}) t
)"""

TABLES = ("orders", "customer", "nation")


def duckdb_ctes(*names: str) -> str:
    """CTE text for DuckDB, where the base tables are pre-registered views."""
    parts = {"raw": RAW_CTES, "preds": PREDS_CTE}
    return ",\n".join(parts[n].format(orders="orders", customer="customer", nation="nation")
                      for n in names)


def table(spark: SparkSession, sf_dir: str, name: str, spread_scan: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_scan:
        from tabprep.operators.partitioning import spread
        df = spread(df)
    return df


def raw(spark: SparkSession, sf_dir: str, spread_scan: bool = False) -> DataFrame:
    """The dirty fixture table: 17 string contract columns + record_id, copy_no.

    ``spread_scan`` spreads the base-table scans (the fact side then drives the
    joins with full parallelism); the joined result itself is not inspected."""
    frames = {t: table(spark, sf_dir, t, spread_scan and t == "orders") for t in TABLES}
    text = "WITH " + RAW_CTES + "\nSELECT * FROM raw"
    return spark.sql(text, **frames)


def preds(spark: SparkSession, sf_dir: str, spread_scan: bool = False) -> DataFrame:
    """Scored rows (row_id, label, score, prediction, split) for the evaluators."""
    text = "WITH " + PREDS_CTE + "\nSELECT * FROM preds"
    return spark.sql(text, orders=table(spark, sf_dir, "orders", spread_scan))
