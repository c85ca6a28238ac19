"""Run catalogue queries next to their SQL in DuckDB and compare the results exactly.

    python tests/compare.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("set threads to 4")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0.0:
        return 0.0
    if hasattr(value, "item"):
        return value.item()
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in records]
    return [names[i] for i in order], sorted(rows, key=repr)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    names, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(rows) != len(want):
        return f"row count {len(rows)} != {len(want)}"
    for got, expected in zip(rows, want):
        if got != expected or [_kind(v) for v in got] != [_kind(v) for v in expected]:
            return f"\n   spark {dict(zip(names, got))}\n   duckdb {dict(zip(names, expected))}"
    return None


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("flowlake-check")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from __spark_entry__ import oracle_sql, queries
    spark, con, failed = session(), duck(args.sf), 0
    oracles = oracle_sql()
    for name, run in queries().items():
        if args.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        started = time.time()
        try:
            df = run(spark, args.sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                note = f"rows only: {len(df.collect())}"
                problem = None
        except Exception as error:  # report and go on with the next query
            problem, note = error, f"ERROR {type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - started:6.1f}s {note}", flush=True)
    print(f"{failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
