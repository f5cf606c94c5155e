"""Compare catalogue queries with their SQL on DuckDB: ``python -m tests.oracle [folder] [key ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, dt.datetime):
        return "timestamp"
    if isinstance(value, dt.date):
        return "date"
    return type(value).__name__


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(_cell, value)) + "]"
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    kinds = [{_kind(r[i]) for r in rows if r[i] is not None} for i in order]
    cells = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    return names, kinds, cells


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs: names, types, row count or the first rows."""
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[2]) != len(want[2]):
        return f"rows {len(got[2])} != {len(want[2])}"
    differing = [(g, w) for g, w in zip(got[2], want[2]) if g != w]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]}"
    if got[1] != want[1]:
        return f"types {list(zip(got[0], got[1], want[1]))}"
    return None


def main() -> int:
    from metroscope import build_session
    from metroscope.catalogue import ORACLES, QUERIES

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                 "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for key in args or QUERIES:
        start = time.time()
        try:
            if key in ORACLES:
                problem = compare(QUERIES[key](spark, folder), con, ORACLES[key])
            else:
                problem = None if QUERIES[key](spark, folder).count() >= 0 else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(args or QUERIES)}; {len(QUERIES)} queries, {len(ORACLES)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(main())
