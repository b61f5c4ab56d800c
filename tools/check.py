"""Compare every query with its SQL in DuckDB, exactly: ``python tools/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import create_session  # noqa: E402
from ledgerline.suite import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# names of the same type on both sides
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    query = QUERIES[name]
    df = query.run(spark, sf_dir)
    got = canonical(df.columns, [tuple(row) for row in df.collect()])
    if query.sql is None:
        return None
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = canonical(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]}
    if wrong:
        return f"types {wrong}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows, expected {len(want)}\n   got      {extra}\n   expected {missing}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = create_session(
        "check", "local[8]", 8, {"spark.driver.memory": "8g", "spark.log.level": "ERROR"}
    )
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}"
              + (f"\n   {problem}" if problem else ""), flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
