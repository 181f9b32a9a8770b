"""Side-by-side check of a Spark query against its DuckDB oracle SQL:
same column names, same row count, same multiset of rows (order-insensitive).

Also usable as a script: ``python -m tests.oracle [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return float(v) if digits is None else round(float(v), digits)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows, order, digits):
    idx = [cols.index(c) for c in order]
    return Counter(tuple(_norm(r[i], digits) for i in idx) for r in rows)


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
                  "smallint": "SMALLINT", "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type differs from the oracle's DuckDB type."""
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = {}
    for f in spark_df.schema.fields:
        st = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if f.name in d and d[f.name] != st:
            out[f.name] = (f.dataType.simpleString(), d[f.name])
    return out


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    out["schema_ok"] = sorted(s_cols) == sorted(d_cols)
    if not out["schema_ok"]:
        out["detail"] = f"spark only {sorted(set(s_cols) - set(d_cols))}, oracle only {sorted(set(d_cols) - set(s_cols))}"
        out["ok"] = False
        return out
    order = sorted(s_cols)
    a, b = _rows(s_cols, s_rows, order, None), _rows(d_cols, d_rows, order, None)
    out["exact"] = a == b
    if not out["exact"]:
        a6, b6 = _rows(s_cols, s_rows, order, 6), _rows(d_cols, d_rows, order, 6)
        out["approx"] = a6 == b6
        if not out["approx"]:
            only_s = list((a6 - b6).elements())[:3]
            only_d = list((b6 - a6).elements())[:3]
            out["detail"] = f"cols={order} spark_only={only_s} oracle_only={only_d}"
    out["types"] = type_mismatches(spark_df, con, sql)
    out["ok"] = out["schema_ok"] and len(s_rows) == len(d_rows) and (out["exact"] or out.get("approx", False))
    return out


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    from quayside.session import build_session
    import __spark_entry__ as entry
    spark = build_session()
    con = duck_connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows-only {n}")
            continue
        try:
            r = compare(fn(spark, sf_dir), con, sqls[name])
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        flag = "OK " if r["ok"] and not r.get("types") else ("TYP" if r["ok"] else "BAD")
        print(f"{name:28s} {flag} {r}")
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
