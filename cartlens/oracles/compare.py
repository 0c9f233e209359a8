"""Compare a Spark result with its DuckDB oracle (row count, column names,
order-insensitive values). Used by the tests and ``tools/check_oracle.py``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from dataclasses import dataclass

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def _sort_key(row):
    return tuple((0, "", "") if x is None else (1, type(x).__name__, str(x)) for x in row)


def _close(a, b) -> bool:
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        a, b = float(a), float(b)
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


@dataclass
class Outcome:
    key: str
    status: str            # OK, NEAR, MISMATCH, ERROR
    spark_rows: int
    oracle_rows: int
    detail: str = ""


def compare(spark, con, key: str, query, oracle_sql: str, sf_dir: str) -> Outcome:
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    res = con.execute(oracle_sql)
    ocols = [d[0] for d in res.description]
    orows = [tuple(norm(x) for x in r) for r in res.fetchall()]
    if sorted(scols) != sorted(ocols):
        return Outcome(key, "MISMATCH", len(srows), len(orows), f"columns {scols} vs {ocols}")
    if len(srows) != len(orows):
        return Outcome(key, "MISMATCH", len(srows), len(orows), "row count")
    si = sorted(range(len(scols)), key=lambda i: scols[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted((tuple(r[i] for i in si) for r in srows), key=_sort_key)
    b = sorted((tuple(r[i] for i in oi) for r in orows), key=_sort_key)
    if a == b:
        return Outcome(key, "OK", len(srows), len(orows))
    for ra, rb in zip(a, b):
        if not all(_close(x, y) for x, y in zip(ra, rb)):
            return Outcome(key, "MISMATCH", len(srows), len(orows), f"first diff {ra} vs {rb}")
    return Outcome(key, "NEAR", len(srows), len(orows))
