"""Runs every registered query next to its SQL and compares the rows: python -m checks.compare [sf_dir] [name ...]."""

import math
import sys
import time

import duckdb

from checks import oracle, registry
from souqframe.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, connection = local_session(), duck(sf_dir)
    sql, failed = oracle.oracle_sql(), []
    for name, run in registry.queries().items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            ours = rows_of(df.columns, [tuple(row) for row in df.collect()])
            seconds = time.perf_counter() - started
            if name not in sql:
                print(f"rows  {name:28} {len(ours):8} rows {seconds:6.2f} s", flush=True)
                continue
            result = connection.execute(sql[name])
            names = [column[0] for column in result.description]
            theirs = rows_of(names, result.fetchall())
        except Exception as problem:  # noqa: BLE001 - one broken query must not hide the others
            failed.append(name)
            print(f"ERROR {name}: {str(problem)[:600]}", flush=True)
            continue
        good = sorted(df.columns) == sorted(names) and ours == theirs
        print(f"{'ok   ' if good else 'DIFF '} {name:28} {len(ours):8} rows {seconds:6.2f} s", flush=True)
        if not good:
            failed.append(name)
            print("   columns", sorted(df.columns), sorted(names), len(ours), len(theirs))
            for mine, other in [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:3]:
                print("   spark ", mine, "\n   duckdb", other)
    unknown = set(sql) - set(registry.queries())
    print("failed:", failed, "SQL without a query:", sorted(unknown))
    return 1 if failed or unknown else 0


if __name__ == "__main__":
    sys.exit(main())
