"""Run registered Spark queries and their DuckDB oracles side by side.

Compares row count, column names and the order-insensitive multiset of rows
(values normalised: decimals and floats by value, dates as ISO text).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else str(v.normalize())
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"query": name, "spark_sec": round(t1 - t0, 2), "spark_rows": len(s_rows)}
    sql = oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    o_names = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    res.update(oracle_rows=len(o_rows),
               columns_match=sorted(s_names) == sorted(o_names),
               rows_match=len(s_rows) == len(o_rows))
    if res["columns_match"]:
        a, b = _rows(s_names, s_rows), _rows(o_names, o_rows)
        res["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            res["only_spark"] = [x for x in a if x not in sb][:3]
            res["only_oracle"] = [x for x in b if x not in sa][:3]
    else:
        res["spark_cols"], res["oracle_cols"] = sorted(s_names), sorted(o_names)
    return res


def main(argv: list[str]) -> int:
    from billing_guard.session import build_session
    from __spark_entry__ import queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and continue with the next query
            r = {"query": name, "error": str(exc).splitlines()[0][:300]}
        ok = r.get("values_match") and r.get("rows_match")
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
