"""Spark-vs-DuckDB result comparison used by the tests (mirrors the
driver's gate: same columns, same row count, same multiset of values)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    from decimal import Decimal
    if isinstance(v, Decimal):
        return float(v)
    return v


def rows_of(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, out


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(t[i]) for i in order) for t in rel.fetchall()]


def compare(spark_df, con, sql: str, tol: float = 0.0) -> tuple[bool, str]:
    s_cols, s_rows = spark_rows(spark_df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    s_rows.sort(key=_key)
    d_rows.sort(key=_key)
    bad = 0
    first = None
    for a, b in zip(s_rows, d_rows):
        for c, x, y in zip(s_cols, a, b):
            same = x == y
            if same and isinstance(x, float) and isinstance(y, float):
                same = repr(x) == repr(y)          # also the sign of zero (hashes see it)
            if not same and isinstance(x, float) and isinstance(y, float) and tol:
                same = abs(x - y) <= tol * max(1.0, abs(x), abs(y))
            if not same:
                bad += 1
                first = first or (c, x, y)
    if bad:
        return False, f"{bad} cells differ, first: {first}"
    return True, f"{len(s_rows)} rows equal"
