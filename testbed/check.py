"""Compare every query with its oracle: ``python -m testbed.check [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb

from testbed.oracle import oracles
from testbed.queries import QUERIES
from watchlytics.session import build_session

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """Connection with the driver's tables as views."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return con


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(map(repr, row)) for row in rows))


def compare(spark, con, sf_dir: str, name: str, sql: str) -> str:
    """'' when columns, types and rows agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*(f"`{c}`" for c in columns)).collect()]
    types = {c: TYPES.get(t, t.upper().replace(",", ", ")) for c, t in df.dtypes}
    result = con.execute(sql)
    described = {d[0]: str(d[1]).replace(",", ", ").replace(",  ", ", ") for d in result.description}
    if sorted(described) != columns:
        return f"columns {columns} / {sorted(described)}"
    order = [list(described).index(c) for c in columns]
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    differing = {c: (types[c], described[c]) for c in columns if types[c] != described[c]}
    if differing:
        return f"types {differing}"
    a, b = _ordered(got), _ordered(want)
    if a != b:
        pair = next((x, y) for x, y in zip(a, b) if x != y)
        diff = [(c, x, y) for c, x, y in zip(columns, *pair) if x != y]
        return f"values {diff}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("CHECK_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, expected, failed = duckdb_tables(sf_dir), oracles(), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, expected[name])
        except Exception:  # report and go on with the next query
            problem = traceback.format_exc(limit=-3)[-1500:]
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
