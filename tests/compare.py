"""Run registered queries on Spark and their SQL on DuckDB and compare the results exactly.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return con


def plain(value):
    """A value in the form both engines share."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(value) -> str:
    return "none" if value is None else type(value).__name__


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None if equal, else what differs first."""
    frame = fn(spark, sf_dir)
    got = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    a, b = rows_of(frame.columns, got), rows_of(names, want)
    if a != b:
        extra, lacking = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"{len(got)} vs {len(want)} rows, {sum((a - b).values())} differ; spark {extra}; sql {lacking}"
    for name in names:
        i, j = frame.columns.index(name), names.index(name)
        kinds = {kind(plain(r[i])) for r in got} | {kind(plain(r[j])) for r in want}
        if len(kinds - {"none"}) > 1:
            return f"column {name} has types {kinds}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as registry
    from tripweave import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), registry.oracle_sql(), 0
    for name, fn in registry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = differences(spark, con, sf_dir, fn, sql[name])
                verdict = problem or "equal"
            else:
                rows = fn(spark, sf_dir).collect()
                problem, verdict = None, f"{len(rows)} rows {rows[:1]}"
        except Exception as error:  # noqa: BLE001 - a broken query must not hide the others
            problem = verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
