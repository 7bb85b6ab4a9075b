"""Run registered queries and their SQL side by side: ``python -m tests.oracle [--sf 0.01] [prefix ...]``."""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time
import traceback

import duckdb

DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return ("", "null")
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("n", repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, float):
        return ("n", "nan" if math.isnan(v) else repr(v + 0.0))
    return ("s", str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, fn, sql):
    """None when both sides agree, else a message."""
    df = fn(spark, folder)
    left = canonical(df.columns, [tuple(x) for x in df.collect()])
    if sql is None:
        return None, len(left[1])
    cur = con.execute(sql)
    right = canonical([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}", len(left[1])
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}; spark {left[1][:3]} sql {right[1][:3]}", len(left[1])
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ: spark {bad[0][0]} sql {bad[0][1]}", len(left[1])
    return None, len(left[1])


def main(argv=None) -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("prefix", nargs="*")
    args = args.parse_args(argv)
    from quarrymill.catalog import ORACLES, QUERIES
    from quarrymill.plans.session import build_session

    spark = build_session("oracle")
    folder = f"{DATA}/sf{args.sf}"
    con = connect(folder)
    failed = []
    for name, fn in QUERIES.items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        start = time.time()
        try:
            message, n = compare(spark, con, folder, fn, ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            message, n = "ERROR " + str(e)[:700], -1
            if os.environ.get("TRACE"):
                traceback.print_exc()
        mark = "FAIL" if message else ("ok" if name in ORACLES else "rows")
        print(f"{mark:5} {name:28} {n:7} {time.time() - start:6.2f}s {message or ''}", flush=True)
        if message or n == 0:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
