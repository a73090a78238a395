"""Run a registered query and its SQL and compare schema, count and values."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import types as T

KINDS = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.StringType: "VARCHAR",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else "") for v in row)


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(names)
    for field in df.schema.fields:
        assert KINDS[type(field.dataType)] == kinds[field.name], field
    order = sorted(names)
    expected = sorted(
        (tuple(row[names.index(n)] for n in order) for row in result.fetchall()), key=key
    )
    found = sorted((tuple(row[n] for n in order) for row in df.collect()), key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a == b
    return len(found)
