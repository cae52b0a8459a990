"""Compare registered Spark queries with their DuckDB oracles.

Row count, column names and an order-insensitive hash of the values, like the
driver's correctness gate.  Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    h = hashlib.sha256(repr(normed).encode()).hexdigest()[:16]
    return [columns[i] for i in order], len(rows), h, normed


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E

    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        df = qs[k](spark, sf_dir)
        s_cols, s_n, s_h, s_rows = digest(df.columns, [tuple(r) for r in df.collect()])
        t1 = time.time()
        if k not in ors:
            results[k] = ("rows-only", s_n)
            if verbose:
                print(f"{k:32s} rows-only  n={s_n}  {t1 - t0:.1f}s", flush=True)
            continue
        rel = con.sql(ors[k])
        o_cols, o_n, o_h, o_rows = digest(rel.columns, rel.fetchall())
        ok = (s_cols == o_cols, s_n == o_n, s_h == o_h)
        results[k] = ok
        if verbose:
            tag = "OK " if all(ok) else "BAD"
            print(f"{k:32s} {tag} cols={ok[0]} n={s_n}/{o_n} hash={ok[2]}  {t1 - t0:.1f}s", flush=True)
            if not all(ok):
                if not ok[0]:
                    print("   spark:", s_cols, "\n   duck: ", o_cols)
                else:
                    only_s = [r for r in s_rows if r not in set(o_rows)][:5]
                    only_o = [r for r in o_rows if r not in set(s_rows)][:5]
                    print("   spark only:", only_s, "\n   duck only: ", only_o)
    return results


if __name__ == "__main__":
    from homeshift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if isinstance(v, tuple) and v and v[0] != "rows-only" and not all(v)]
    print("BAD:", bad)
