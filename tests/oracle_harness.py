"""Run a catalog query in Spark and its oracle SQL in DuckDB; compare rows.

Comparison: same column names, same row count, same multiset of rows after columns are
sorted by name, doubles rounded to 6 places.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = bool(int(__import__("os").environ.get("STRICT", "0")))


def _norm(v):
    if STRICT:
        if isinstance(v, float):
            return ("f", repr(v))
        if isinstance(v, decimal.Decimal):
            return ("d", str(v))
        if isinstance(v, (list, tuple)):
            return tuple(_norm(x) for x in v)
        return (type(v).__name__, v) if not isinstance(v, (_dt.datetime, _dt.date)) else v.isoformat()
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return v


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, key, sf_dir, con=None, show=3):
    from netsieve.plans import catalog
    q = catalog.queries()[key]
    sql = catalog.oracle_sql().get(key)
    sdf = q(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    if sql is None:
        return {"key": key, "rows": len(srows), "oracle": None, "ok": None}
    con = con or duck_connect(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sm = rows_multiset(scols, srows)
    dc, dm = rows_multiset(dcols, drows)
    ok = sc == dc and sm == dm
    out = {"key": key, "rows": len(srows), "oracle_rows": len(drows), "ok": ok}
    if not ok:
        out["spark_cols"] = sc
        out["duck_cols"] = dc
        out["only_spark"] = list((sm - dm).items())[:show]
        out["only_duck"] = list((dm - sm).items())[:show]
    return out


if __name__ == "__main__":
    import json
    import os
    import time
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from netsieve.session import get_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", shuffle_partitions=int(os.environ.get("SHUFFLE", "8")),
                        extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from netsieve.plans import catalog
    keys = sys.argv[1:] or sorted(catalog.queries())
    con = duck_connect(sf)
    bad = 0
    for k in keys:
        t = time.time()
        try:
            r = compare(spark, k, sf, con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:600], "ok": False}
        r["sec"] = round(time.time() - t, 2)
        bad += r.get("ok") is False
        print(json.dumps(r, default=str), flush=True)
    print("FAILED", bad)
