"""Runs registered queries next to their SQL in DuckDB and compares names, row counts and values.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def kinds(columns, rows):
    found: dict[str, set] = {}
    for row in rows[:200]:
        for name, value in zip(columns, row):
            if value is not None:
                found.setdefault(name, set()).add(type(value).__name__)
    return found


def compare(name, frame, con, sql):
    """Error text, or None where both sides agree."""
    spark_rows = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(frame.columns) != sorted(sql_columns):
        return f"columns {sorted(frame.columns)} / {sorted(sql_columns)}", len(spark_rows)
    left, right = rows_of(frame.columns, spark_rows), rows_of(sql_columns, sql_rows)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}", len(left)
    if kinds(frame.columns, spark_rows) != kinds(sql_columns, sql_rows):
        return f"types {kinds(frame.columns, spark_rows)} / {kinds(sql_columns, sql_rows)}", len(left)
    for a, b in zip(left, right):
        if a != b:
            return f"values\n   {a}\n   {b}", len(left)
    return None, len(left)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    sys.path.insert(0, ".")
    import __spark_entry__ as driver
    from tests.conftest import make_session

    spark = make_session()
    con = connect(args.sf)
    queries, sql = driver.queries(), driver.oracle_sql()
    bad = 0
    for name in args.names or queries:
        started = time.time()
        try:
            frame = queries[name](spark, args.sf)
            if name in sql:
                problem, count = compare(name, frame, con, sql[name])
            else:
                problem, count = None, frame.count()
        except Exception as error:  # noqa: BLE001 - the run goes on with the next query
            problem, count = str(error)[:1500] + traceback.format_exc()[-300:], -1
        flag = "ok  " if problem is None else "FAIL"
        bad += problem is not None
        extra = "" if name in sql else " (rows only)"
        print(f"{flag} {name}{extra} rows={count} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
