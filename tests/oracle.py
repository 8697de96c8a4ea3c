"""Runs registered queries against their SQL in DuckDB and compares all values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if value is None or str(value) in ("NaT", "<NA>"):
        return None
    return value


def rows_of(table):
    """Rows of an Arrow table with columns sorted by name, as a sorted list."""
    names = sorted(table.column_names)
    lists = [[_plain(v) for v in table.column(name).to_pylist()] for name in names]
    return names, sorted(zip(*lists), key=lambda row: [(v is None, str(v)) for v in row])


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def kind_of(arrow_type) -> str:
    import pyarrow.types as pt

    if pt.is_integer(arrow_type) or pt.is_decimal(arrow_type):
        return "integer"
    if pt.is_floating(arrow_type):
        return "float"
    if pt.is_timestamp(arrow_type):
        return "timestamp" + (" with zone" if arrow_type.tz else "")
    if pt.is_string(arrow_type) or pt.is_large_string(arrow_type):
        return "string"
    return str(arrow_type)


def compare(spark, name, query, sql, folder) -> str | None:
    """What differs, or None."""
    got = query(spark, folder).toArrow()
    want = duck(folder).sql(sql).to_arrow_table()
    got_names, got_rows = rows_of(got)
    want_names, want_rows = rows_of(want)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    for column in got_names:
        a, b = (kind_of(t.schema.field(column).type) for t in (got, want))
        if a != b:
            return f"type of {column}: {a} != {b}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows != {len(want_rows)}"
    for a, b in zip(got_rows, want_rows):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from tests.conftest import make_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = make_session()
    failed = 0
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        sql = contract.oracle_sql().get(name)
        try:
            if sql is None:
                problem = f"no SQL; {query(spark, folder).count()} rows"
            else:
                problem = compare(spark, name, query, sql, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name:36s} {problem or 'ok'}", flush=True)
    print("failed:", failed)
