"""Run registered queries next to their SQL twins and compare all values.

    python tests/compare.py [--sf DIR] [key or key prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(round(float(value), 9) + 0.0)
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in data)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, key, fn, sql):
    """None when equal, else a description of the difference."""
    result = fn(spark, sf_dir)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    if not want:
        return "SQL gives no rows"
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} rows, SQL {len(want)}\n    only spark {sorted(a - b)[:3]}\n    only sql   {sorted(b - a)[:3]}"
    return None


def main():
    import __spark_entry__ as entry
    from ledgerlane.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--conf", action="append", default=[], help="key=value for the session")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", **dict(c.split("=", 1) for c in args.conf)})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    sqls = entry.oracle_sql()
    failed = []
    for key, fn in entry.queries().items():
        if args.keys and not any(key.startswith(k) for k in args.keys):
            continue
        begin = time.time()
        try:
            problem = compare(spark, con, args.sf, key, fn, sqls.get(key))
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error))[:1500]
        mark = "ok " if problem is None else "BAD"
        print(f"{mark} {key:28s} {time.time() - begin:6.2f}s {'' if key in sqls else '(rows only)'}", flush=True)
        if problem:
            failed.append(key)
            print("   ", problem, flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
