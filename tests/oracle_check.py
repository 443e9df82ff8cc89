"""Run catalog queries next to their DuckDB twins and compare every value.

    python tests/oracle_check.py [--dir DIR] [--cpus N] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql) -> str | None:
    """None if equal, else a short description of the first difference."""
    mine = sorted_rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = sorted_rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("--module", default=None, help="only this plan module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from larkspur.plans.registry import CATALOG
    from larkspur.session import build_session

    if args.module:
        importlib.import_module(f"larkspur.plans.{args.module}")
    else:
        importlib.import_module("larkspur.plans").load_all()
    spark = build_session(f"local[{args.cpus}]", **{"spark.sql.shuffle.partitions": args.cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(args.dir), 0
    for name, q in CATALOG.items():
        if args.names and name not in args.names:
            continue
        if args.module and not q.build.__module__.endswith(args.module):
            continue
        start = time.time()
        try:
            if q.sql:
                problem = compare(q(spark, args.dir), con, q.sql)
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                rows = q(spark, args.dir).collect()
                state = f"rows {len(rows)} {str(rows[:2])[:300]}"
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on
            problem = state = f"ERROR {type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{name:40s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
