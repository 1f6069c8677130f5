"""Compare registered queries with their SQL in DuckDB.

    python -m zilverspoor.checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def normal(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def compare(df, connection, sql: str) -> str | None:
    """``None`` when both give the same columns, types and rows, else what differs."""
    types = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for field in df.schema:
        kind = field.dataType.simpleString()
        if field.name in types and SAME_TYPES.get(kind) != types[field.name]:
            return f"{field.name} is {kind} instead of {types[field.name]}"
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got, want = rows_of(df.columns, df.collect()), rows_of(names, expected)
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows instead of {sum(want.values())}; "
            f"{sum(extra.values())} unexpected, e.g. {list(extra)[:2]}; missing e.g. {list(missing)[:2]}"
        )
    return None


def main() -> int:
    from zilverspoor.checks import CHECKS, queries
    from zilverspoor.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", spark__master="local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(args.sf), 0
    known = queries()
    for name in args.names or known:
        started = time.time()
        try:
            df = known[name](spark, args.sf)
            sql = CHECKS[name].sql
            problem = compare(df, connection, sql) if sql else None
            note = "" if sql else f" rows only ({df.count()})"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s{note}", flush=True)
        if problem:
            print(f"     {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
