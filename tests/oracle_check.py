"""Local stand-in for the driver's correctness gate: run each registered
Spark query and its DuckDB oracle on the same tables and compare row count,
column names and an order-insensitive multiset of normalised rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    import os
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols_raw = [d[0] for d in rel.description]
    d_rows_raw = rel.fetchall()
    d_cols = sorted(d_cols_raw)
    idx = [d_cols_raw.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows_raw]
    ok_cols = s_cols == d_cols
    ok_n = len(s_rows) == len(d_rows)
    cs, cd = Counter(s_rows), Counter(d_rows)
    ok_v = cs == cd
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name:32s} rows spark={len(s_rows)} duck={len(d_rows)} cols={'ok' if ok_cols else (s_cols, d_cols)} "
          f"vals={'ok' if ok_v else 'diff'} spark_s={t1 - t0:.1f}", flush=True)
    if not ok_v and ok_cols:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        print("   only spark:", only_s)
        print("   only duck :", only_d)
    return status == "OK "


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tillhouse.session import get_session
    sf_dir = "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in os_:
            df = qs[name](spark, sf_dir)
            print(f"--- {name:32s} no oracle, rows={df.count()}")
            continue
        try:
            bad += not compare(spark, name, qs[name], os_[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:800]}")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
