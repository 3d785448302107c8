"""Compare registered queries with their SQL counterparts, cell by cell and order-insensitive."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _cell(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in r))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows, otherwise what differs."""
    got_names, got = frame.columns, [tuple(r) for r in frame.collect()]
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    mine, theirs = _rows(got_names, got), _rows(want_names, want)
    if mine == theirs:
        return ""
    if len(mine) != len(theirs):
        only = [r for r in mine if r not in set(theirs)][:2], [r for r in theirs if r not in set(mine)][:2]
        return f"rows {len(mine)} != {len(theirs)}; only spark / only sql: {only}"
    first = next((a, b) for a, b in zip(mine, theirs) if a != b)
    return f"values differ, first: {first}"


def main(sf_dir: str, names: list[str]) -> int:
    from scenarios.oracles import ORACLES
    from scenarios.queries import QUERIES
    from tidelog.session import session

    spark = session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle_connection(sf_dir), 0
    for name in names or sorted(QUERIES):
        begun = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            what = difference(frame, con, ORACLES[name]) if name in ORACLES else "no oracle"
        except Exception as problem:  # report and go on with the next query
            what = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += bool(what)
        print(f"{'ok  ' if not what else 'DIFF'} {name} {time.time() - begun:.2f}s {what}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
