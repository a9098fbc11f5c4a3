"""Spark-vs-DuckDB comparison used by the oracle tests and by hand:

    python tests/oracle_compare.py [sf_dir] [query ...]

Compares column names, row count and an order-insensitive hash of the values
(columns sorted by name, floats rounded to 6 digits)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return [columns[i] for i in order], out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    df = qfn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    ok_cols = sc == dc
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    d_types = {d[0]: str(d[1]) for d in res.description}
    type_issues = {c: (s_types[c], d_types.get(c)) for c in s_types
                   if c in d_types and _TYPE_MAP.get(s_types[c], s_types[c]) != d_types[c]}
    ok_n = len(sr) == len(dr)
    ok_hash = ok_cols and digest(sr) == digest(dr)
    info = dict(query=name, cols=ok_cols, rows=(len(sr), len(dr)), hash=ok_hash,
                spark_sec=round(t1 - t0, 2))
    if type_issues:
        info["types"] = type_issues
    if not ok_cols:
        info["spark_only"] = sorted(set(sc) - set(dc))
        info["duck_only"] = sorted(set(dc) - set(sc))
    elif not ok_hash:
        a, b = set(sr), set(dr)
        info["example_spark_only"] = list(a - b)[:2]
        info["example_duck_only"] = list(b - a)[:2]
    return info


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from winback.session import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, oq = queries(), oracle_sql()
    bad = 0
    for n in (names or list(qs)):
        if n not in oq:
            df = qs[n](spark, sf_dir)
            print({"query": n, "rows_only": df.count()})
            continue
        info = compare(spark, con, n, qs[n], oq[n], sf_dir)
        bad += not (info["cols"] and info["hash"])
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
