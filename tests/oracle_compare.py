"""Compare a registered Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive multiset of values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if v is None or isinstance(v, (str, bool, int)) else str(v)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        res["match"] = False
        return res
    si = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    di = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    sv = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
    dv = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
    res["values_match"] = sv == dv
    res["match"] = res["values_match"] and len(s_rows) == len(d_rows)
    res["spark_types"] = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    res["oracle_types"] = dict(zip(d_cols, [str(t) for t in rel.types]))
    if not res["values_match"]:
        sset, dset = set(sv), set(dv)
        res["only_spark"] = [x for x in sv if x not in dset][:3]
        res["only_oracle"] = [x for x in dv if x not in sset][:3]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from lakecheck.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sqls[name], sf, con) if name in sqls else {"name": name, "match": None}
        except Exception as e:  # report and continue
            r = {"name": name, "match": False, "error": repr(e)[:800]}
        bad += r.get("match") is False
        print(r, flush=True)
    print("MISMATCHES", bad)
