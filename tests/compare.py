"""Compare a Spark result with the SQL result: columns, types, row count, values in any order."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = ("events", "documents", "conversations")

_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral() else float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row),
    )


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in result.description}
    spark_types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == sql_types
    expected = _rows([d[0] for d in result.description], result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(expected), f"{len(got)} rows, expected {len(expected)}"
    for g, e in zip(got, expected):
        assert g == e, f"{g} is not {e}"
    return len(got)
