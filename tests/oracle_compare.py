"""Spark-vs-DuckDB comparison used by the tests (row count, column names and
types, order-insensitive value hash), mirroring the driver's check."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.12g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return cols, res.fetchall()


#: Spark and DuckDB names of one kind of value; a column must be of the same kind in both.
KINDS = {"long": "int", "int": "int", "short": "int", "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "string": "text", "VARCHAR": "text",
         "double": "float", "DOUBLE": "float", "FLOAT": "float", "bigint": "int", "float": "float", "boolean": "bool", "BOOLEAN": "bool",
         "date": "date", "DATE": "date", "timestamp": "time", "timestamp_ntz": "time", "TIMESTAMP": "time", "TIMESTAMP WITH TIME ZONE": "time"}


def kinds(pairs) -> dict[str, str]:
    return {name: "decimal" if str(t).upper().startswith("DECIMAL") else KINDS.get(str(t), str(t)) for name, t in pairs}


def compare(spark_df, con, sql: str) -> dict:
    sc, sr = spark_rows(spark_df)
    dc, dr = duck_rows(con, sql)
    duck_kinds = kinds((d[0], d[1]) for d in con.execute(sql).description)
    sn, sh = digest(sc, sr)
    dn, dh = digest(dc, dr)
    out = {"rows_spark": sn, "rows_oracle": dn, "cols_equal": sorted(sc) == sorted(dc) and kinds(spark_df.dtypes) == duck_kinds, "hash_equal": sh == dh}
    if not out["cols_equal"]:
        out["kinds"] = kinds(spark_df.dtypes), duck_kinds
    if not out["hash_equal"]:
        order_s = sorted(range(len(sc)), key=lambda i: sc[i])
        order_d = sorted(range(len(dc)), key=lambda i: dc[i])
        s_lines = sorted("|".join(_norm(r[i]) for i in order_s) for r in sr)
        d_lines = sorted("|".join(_norm(r[i]) for i in order_d) for r in dr)
        s_only = sorted(set(s_lines) - set(d_lines))[:3]
        d_only = sorted(set(d_lines) - set(s_lines))[:3]
        out["cols"] = sorted(sc), sorted(dc)
        out["spark_only"], out["oracle_only"] = s_only, d_only
    return out
