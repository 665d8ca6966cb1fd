"""Compare a Spark DataFrame with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import hashlib
import math

import duckdb

from ledgerline.session import TEST_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v) if v is not None else "<null>"


def digest(rows: list[tuple]) -> str:
    lines = sorted("|".join(_norm(v) for v in r) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(df, con, sql: str) -> dict:
    cols = sorted(df.columns)
    spark_rows = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
    out = {"spark_rows": len(spark_rows), "duck_rows": len(drows),
           "columns_match": sorted(dcols) == cols, "spark_cols": cols, "duck_cols": sorted(dcols)}
    if idx is None:
        out["match"] = False
        return out
    duck_rows = [tuple(r[i] for i in idx) for r in drows]
    out["match"] = digest(spark_rows) == digest(duck_rows)
    if not out["match"]:
        s, d = set(map(lambda r: tuple(map(_norm, r)), spark_rows)), set(
            map(lambda r: tuple(map(_norm, r)), duck_rows))
        out["only_spark"] = sorted(s - d)[:3]
        out["only_duck"] = sorted(d - s)[:3]
    return out
