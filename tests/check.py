"""Side-by-side check: each query on Spark and its SQL on DuckDB, same rows expected.

    python -m tests.check [--sf 0.01] [names...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(set(spark_df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for left, right in zip(got, want):
        if repr(left) != repr(right):
            cells = [(n, a, b) for n, a, b in zip(sorted(names), left, right) if repr(a) != repr(b)]
            bad = sum(repr(a) != repr(b) for a, b in zip(got, want))
            return f"{bad} rows differ, first: {cells[:4]}"
    return None


def main() -> None:
    from tidelog.catalog.oracle import ORACLE
    from tidelog.catalog.queries import QUERIES
    from tidelog.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            problem = compare(frame, con, ORACLE[name]) if name in ORACLE else f"no oracle ({frame.count()} rows)"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} not ok; oracle without query: {sorted(set(ORACLE) - set(QUERIES))}")


if __name__ == "__main__":
    main()
