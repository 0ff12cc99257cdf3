"""Compare queries() with oracle_sql() the way the driver does (exact, order-insensitive).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(records, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, key, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols, r)) for r in res.fetchall()]
    t2 = time.time()
    s_cols = sorted(sdf.columns)
    if s_cols != sorted(d_cols):
        return f"COLUMNS differ spark={s_cols} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return f"ROWCOUNT spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, s_cols)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"VALUES {len(bad)} rows differ, e.g. {s_cols}\n  spark={bad[0][0]}\n  duck ={bad[0][1]}"
    return f"ok ({len(s_rows)} rows, spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s)"


def main():
    import __spark_entry__ as E
    from histwise.session import local_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    for key in (keys or list(qs)):
        if key not in os_:
            n = qs[key](spark, sf_dir).count()
            print(f"{key:40s} rows-only: {n} rows", flush=True)
            continue
        try:
            msg = compare(spark, con, key, qs[key], os_[key], sf_dir)
        except Exception as e:  # report and go on
            msg = f"ERROR {type(e).__name__}: {str(e)[:400]}"
        print(f"{key:40s} {msg}", flush=True)


if __name__ == "__main__":
    main()
