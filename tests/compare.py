"""Side-by-side runs of the registered queries against DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _order(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _clean(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    data = sorted((tuple(_clean(row[i]) for i in places) for row in rows), key=_order)
    return [columns[i] for i in places], data


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, row count and every value agree exactly."""
    got = table(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    cursor = con.execute(sql)
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(n, x, y) for n, x, y in zip(got[0], a, b) if x != y or type(x) is not type(y)]
            return f"differs at {bad[:4]} in row {a[:4]}"
    return None
