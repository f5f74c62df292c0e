"""Runs a registered query in Spark and its SQL in DuckDB, and compares columns and rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted((TESTDATA / sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    names = [columns[i] for i in order]
    return names, Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_bag(frame):
    return _bag(frame.columns, frame.collect())


def sql_bag(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return _bag(columns, result.fetchall())


def differences(frame, con, sql: str) -> list[str]:
    """Empty when both agree."""
    ours, theirs = spark_bag(frame), sql_bag(con, sql)
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} against {theirs[0]}"]
    notes = [f"{sum(ours[1].values())} rows against {sum(theirs[1].values())}"]
    missing, extra = theirs[1] - ours[1], ours[1] - theirs[1]
    notes += [f"missing {row}" for row in list(missing)[:2]] + [f"extra {row}" for row in list(extra)[:2]]
    return notes if missing or extra else []
