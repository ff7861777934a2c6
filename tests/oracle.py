"""Local oracle harness: run a registered Spark query and its DuckDB SQL and compare.

Usage: ``python -m tests.oracle [sf_dir] [key ...]`` (default sf0.01, all keys).
Comparison mirrors the driver: same row count, same column names, and an
order-insensitive multiset of rows, floats compared bit for bit (``--loose``
compares them to 9 significant digits instead).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = True   # floats compared bit for bit; --loose compares 9 significant digits


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, key: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = {"key": key, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "spark_sec": round(t1 - t0, 3)}
    res["values_match"] = res["cols_match"] and _rows(scols, srows) == _rows(dcols, drows)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(scols)
        res["oracle_cols"] = sorted(dcols)
    elif not res["values_match"]:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_oracle"] = [x for x in b if x not in sa][:3]
    return res


def main(argv):
    sys.path.insert(0, ".")
    from gridledger.session import build_session
    import __spark_entry__ as E
    global EXACT
    if argv and argv[0] in ("--exact", "--loose"):
        EXACT, argv = argv[0] == "--exact", argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(E.queries())
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print(f"{k}: rows-only {df.count()}")
            continue
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        except Exception as exc:  # noqa: BLE001
            r = {"key": k, "error": repr(exc)[:400]}
        ok = r.get("values_match") and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
