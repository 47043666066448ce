"""Run registered queries in Spark and their oracle SQL in DuckDB, compare
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    hs = sorted(hashlib.sha1("|".join(norm(r[i]) for i in order).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


def run(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    qs, sql = E.queries(), E.oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t0
        if name not in sql:
            results[name] = ("rows-only", len(rows))
            continue
        cur = con.execute(sql[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        ok = (len(rows) == len(orows) and sorted(cols) == sorted(ocols)
              and digest(rows, cols) == digest(orows, ocols))
        results[name] = (ok, len(rows), len(orows), dt)
        if verbose:
            print(f"{'OK ' if ok else 'BAD'} {name}: spark={len(rows)} oracle={len(orows)} "
                  f"{dt:.1f}s" + ("" if sorted(cols) == sorted(ocols) else f" cols {cols} vs {ocols}"),
                  flush=True)
    return results


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tapeworks.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(local_session(8), sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] is not True]
    print(f"{len(res) - len(bad)}/{len(res)} match" + (f"; mismatches: {bad}" if bad else ""))
    sys.exit(1 if bad else 0)
