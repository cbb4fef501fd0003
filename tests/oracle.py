"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, f, text):
    """None if equal, else what differs; with the two run times."""
    start = time.time()
    df = f(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    middle = time.time()
    if text is None:
        return None, middle - start, 0.0, len(ours[1])
    rel = con.execute(text)
    theirs = _rows([c[0] for c in rel.description], rel.fetchall())
    end = time.time()
    problem = None
    if ours[0] != theirs[0]:
        problem = f"columns {set(ours[0]) ^ set(theirs[0])}"
    elif len(ours[1]) != len(theirs[1]):
        problem = f"rows {len(ours[1])} against {len(theirs[1])}; first {ours[1][:1]} against {theirs[1][:1]}"
    elif ours[1] != theirs[1]:
        bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
        cells = {c for a, b in bad for c, x, y in zip(ours[0], a, b) if x != y}
        problem = f"{len(bad)} of {len(ours[1])} rows differ in {sorted(cells)}"
        a, b = bad[0]
        problem += "; first " + str([(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y][:4])
    return problem, middle - start, end - middle, len(ours[1])


def main():
    from procurelytics.plans.catalog import ORACLES, QUERIES
    from procurelytics.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--plain", action="store_true", help="a session with Spark's own defaults")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"{TESTDATA}/sf{args.sf}"
    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").getOrCreate()
    else:
        spark = local_session(8)
    con = connect(folder)
    bad = 0
    for name in args.names or list(QUERIES):
        try:
            problem, ours, theirs, rows = compare(spark, con, folder, name, QUERIES[name], ORACLES.get(name))
            kind = "  " if name in ORACLES else "R "
            print(f"{'ok ' if problem is None else 'BAD'} {kind}{name:34s} {rows:7d} rows {ours:6.2f}s duckdb {theirs:5.2f}s {problem or ''}", flush=True)
            bad += problem is not None
        except Exception as error:
            bad += 1
            print(f"ERR {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
