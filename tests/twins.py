"""Run registered queries beside their SQL counterparts and compare all values."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402


def plain(value):
    """One form for the values both engines return."""
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    if isinstance(value, dict):
        return tuple(plain(item) for item in value.values())
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def check(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    begin = time.time()
    frame = spark_entry.queries()[name](spark, sf_dir)
    got = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    spark_seconds = time.time() - begin
    begin = time.time()
    relation = connection.execute(spark_entry.oracle_sql()[name])
    wanted = sorted_rows([column[0] for column in relation.description], relation.fetchall())
    times = f"spark {spark_seconds:.1f} s, sql {time.time() - begin:.1f} s, {len(got[1])} rows"
    if got == wanted:
        return True, times
    if got[0] != wanted[0]:
        return False, f"columns {got[0]} != {wanted[0]}"
    differing = [(a, b) for a, b in zip(got[1], wanted[1]) if a != b][:3]
    return False, f"{len(got[1])} rows, {len(wanted[1])} wanted, first differing {differing} ({times})"


if __name__ == "__main__":
    from conftest import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    session, database = build_session(), duck(folder)
    failed = 0
    for query in spark_entry.oracle_sql():
        if only and query not in only:
            continue
        try:
            good, text = check(session, database, query, folder)
        except Exception as error:  # noqa: BLE001 - shown and counted
            good, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not good
        print("ok  " if good else "FAIL", query, text, flush=True)
    print("failed:", failed)
