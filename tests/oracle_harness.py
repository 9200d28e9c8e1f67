"""Run a registered Spark query and its DuckDB oracle side by side and compare
row count, column names and an order-insensitive value multiset."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _num(v: float, digits):
    if math.isnan(v):
        return "∅"
    r = round(v, digits)
    return repr(int(r)) if r == int(r) and abs(r) < 2**53 else repr(r)


def _canon(v, digits):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return _num(v, digits)
    if isinstance(v, pd.Timestamp):
        return "∅" if pd.isna(v) else v.isoformat()
    try:
        if pd.isna(v):
            return "∅"
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
        if isinstance(v, float):
            return _num(v, digits)
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return repr(list(v.tolist() if hasattr(v, "tolist") else v))
    return repr(v) if not isinstance(v, str) else v


def canon_rows(df: pd.DataFrame, digits=9):
    cols = sorted(df.columns)
    rows = [tuple(_canon(v, digits) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT", "float": "FLOAT",
                 "date": "DATE"}


def type_diffs(spark_df, con, sql):
    """Columns whose Spark type does not map onto the DuckDB result type."""
    duck_types = {r[0]: r[1] for r in con.execute(f"SELECT column_name, column_type FROM (DESCRIBE ({sql}))").fetchall()}
    out = []
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duckdb {got}")
    return out


def compare(spark, con, name, fn, sql, sf_dir, digits=9):
    sdf_spark = fn(spark, sf_dir)
    sdf = sdf_spark.toPandas()
    odf = con.execute(sql).df()
    sc, sr = canon_rows(sdf, digits)
    oc, orows = canon_rows(odf, digits)
    problems = []
    if sc != oc:
        problems.append(f"columns differ: spark={sc} oracle={oc}")
    if len(sr) != len(orows):
        problems.append(f"row count spark={len(sr)} oracle={len(orows)}")
    if not problems and sr != orows:
        diff = [(a, b) for a, b in zip(sr, orows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    td = type_diffs(sdf_spark, con, sql)
    if td:
        problems.append("types differ: " + "; ".join(td))
    return len(sr), problems


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tabprep.registry import ORACLE, QUERIES
    from tabprep.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(QUERIES):
        if name not in ORACLE:
            n = QUERIES[name](spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows (no oracle)")
            continue
        try:
            n, problems = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            n, problems = -1, [f"error: {str(exc)[:600]}"]
        bad += bool(problems)
        print(("OK    " if not problems else "FAIL  ") + f"{name}: {n} rows " + "; ".join(problems), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    sys.exit(1 if main(args or None, sf) else 0)
