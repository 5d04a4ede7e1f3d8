"""Compare every catalogue query with its DuckDB oracle (rows, column names, values).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 9):.9f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.9f}")
    return (3, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}", t1 - t0
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}", t1 - t0
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}", t1 - t0
    types = dict(sdf.dtypes)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    return True, f"{len(s_rows)} rows; types spark={sorted(types.items())} duck={sorted(duck_types.items())}", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not os.path.isdir(a)]
    from driftgate.session import local_session
    import __spark_entry__ as E

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            ok, msg, sec = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # report and go on
            ok, msg, sec = False, f"error: {type(exc).__name__}: {str(exc)[:400]}", 0.0
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {sec:6.2f}s {msg[:600] if not ok else msg.split(';')[0]}", flush=True)
    print(f"{len(qs) - bad if not only else len(only) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
