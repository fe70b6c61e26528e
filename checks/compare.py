"""Run queries and their SQL on the same tables and compare: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from clickcast.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, name: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(ORACLE[name])
    return _canonical([d[0] for d in result.description], result.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return _canonical(df.columns, [tuple(r) for r in df.collect()])


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con, failed = local_session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.time()
        got = spark_rows(QUERIES[name](spark, sf_dir))
        seconds = time.time() - start
        if name not in ORACLE:
            verdict = "rows only"
        else:
            expected = oracle_rows(con, name)
            verdict = "equal" if [repr(r) for r in got[1]] == [repr(r) for r in expected[1]] and got[0] == expected[0] else "DIFFERS"
            if verdict == "DIFFERS":
                failed += 1
                missing = set(expected[1]) - set(got[1])
                extra = set(got[1]) - set(expected[1])
                print("  columns", got[0], expected[0], "rows", len(got[1]), len(expected[1]))
                print("  missing", list(missing)[:3], "extra", list(extra)[:3])
        print(f"{name:36s} {verdict:10s} {len(got[1]):8d} rows {seconds:7.2f} s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
