"""Run registered queries next to their SQL and report differences.

    python tests/oracle_check.py /root/testdata/sf0.01 [name-part ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def compare(spark, con, sf_dir, fn, sql):
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}", len(got)
    types = {n: str(t) for n, t in zip(names, con.execute("DESCRIBE " + sql).fetchall())}
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}", len(got)
    if got != want:
        cols = sorted(df.columns)
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        g, w = bad[0]
        diff = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b]
        return f"{len(bad)} rows differ, first: {diff}", len(got)
    del types
    return None, len(got)


def main():
    from tests.conftest import session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    import __spark_entry__ as entry

    spark, con = session(), duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            diff, n = compare(spark, con, sf_dir, fn, sqls.get(name))
        except Exception as e:  # report and go on
            diff, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        mark = "ok" if diff is None else "DIFF"
        if diff is None and name not in sqls:
            mark = "no-sql"
        bad += diff is not None
        print(f"{mark:6} {name:28} {n:8} rows {time.time() - t:6.2f}s {diff or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
