"""Run a query on Spark and its SQL on DuckDB; compare names, types and rows exactly."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    names = df.columns
    types = {n: _TYPES.get(t, t) for n, t in df.dtypes}
    return types, _rows(names, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    return types, _rows(names, cur.fetchall())


def differences(df, con, sql) -> str:
    """Empty if the results are equal."""
    st, sr = spark_rows(df)
    dt, dr = duck_rows(con, sql)
    if st != dt:
        return f"schema: spark {st} duckdb {dt}"
    if sr != dr:
        return (
            f"rows: spark {sum(sr.values())} duckdb {sum(dr.values())}; only spark {list((sr - dr).items())[:3]}; "
            f"only duckdb {list((dr - sr).items())[:3]}"
        )
    return "" if sr else "both empty"
