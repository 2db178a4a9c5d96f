"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, columns):
    """Rows with columns in name order, as sorted tuples of comparable text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(value):
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else repr(round(value, 9) + 0.0)
        return repr(value)

    return sorted(tuple(show(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    found = con.execute(sql)
    want_columns = [c[0] for c in found.description]
    want = canonical(found.fetchall(), want_columns)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} instead of {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"row {mine} instead of {theirs}"
    return None


def main() -> None:
    """Compare the queries named on the command line (all without names)."""
    import __spark_entry__ as entry
    from tests.conftest import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            result = differences(df, con, sql[name]) if name in sql else f"{df.count()} rows, no SQL"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {result or 'equal'}", flush=True)


if __name__ == "__main__":
    main()
