"""Runs registered queries and their SQL on the same folder and compares values."""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v) + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(cols), sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (list, dict)) else str(x) for x in r))


def compare(spark, con, folder, query, sql):
    df = query(spark, folder)
    a = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    b = _sorted([c[0] for c in cur.description], cur.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} vs {b[0]}"
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} vs {len(b[1])}"
    if not a[1]:
        return "empty"
    bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    return f"{len(bad)} of {len(a[1])} rows differ, first {bad[0]} in {a[0]}" if bad else ""


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from oddspend.session import local_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    q, o = entry.queries(), entry.oracle_sql()
    print("no SQL:", sorted(set(q) - set(o)), "no query:", sorted(set(o) - set(q)))
    failed = 0
    for name in q:
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in o:
                res = compare(spark, con, folder, q[name], o[name])
            else:
                n = q[name](spark, folder).count()
                res = "" if n else "empty"
        except Exception as e:
            res = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(res)
        print(f"{'FAIL' if res else 'ok  '} {name} {time.time() - t:.2f}s {res[:900]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
