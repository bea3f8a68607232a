"""Compare registered queries with their SQL in DuckDB: column names, types and every value.

``python tests/oracle_check.py [folder] [name part ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import re
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN",
    T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([repr(tuple(plain(r[i]) for i in order)) for r in rows])


def compare(df, con, sql) -> tuple[str, int]:
    got = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = [str(c[1]) for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(got)
    if len(set(names)) != len(names):
        return "duplicate column names", len(got)
    for f in df.schema:
        kind = kinds[names.index(f.name)]
        mine = KINDS.get(type(f.dataType))
        if mine and mine != kind:
            return f"type of {f.name}: {mine} / {kind}", len(got)
        if isinstance(f.dataType, (T.NullType, T.TimestampType)):
            return f"type of {f.name}: {f.dataType}", len(got)
    a, b = table(df.columns, got), table(names, want)
    if a == b:
        return "", len(got)
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)}/{len(b)}; {len(only_a)}+{len(only_b)} differ; spark {only_a[:2]} sql {only_b[:2]}", len(got)


def main() -> int:
    from flowgauge.plans import load_all
    from flowgauge.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for q in load_all().values():
        if args and not any(re.search(a, q.name) or a in q.covers for a in args):
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            if q.sql is None:
                problem, n = "", df.count()
            else:
                problem, n = compare(df, con, q.sql)
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:900]}", -1
        bad += bool(problem)
        mark = "FAIL" if problem else ("rows" if q.sql is None else "ok")
        print(f"{mark:4} {time.time() - start:6.2f}s {n:7d} {q.name} {problem}", flush=True)
        if n == 0:
            print("     EMPTY", q.name)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
