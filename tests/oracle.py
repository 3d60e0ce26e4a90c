"""Comparison of a Spark result with DuckDB's result on the same files."""

from __future__ import annotations

import glob
import os

import duckdb

# DuckDB type names of Spark's, as far as results use them.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{file}')")
    return con


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs in columns, types or rows; None if nothing does."""
    expected = con.sql(sql)
    columns = sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    if sorted(spark_df.columns) != columns:
        return f"columns {sorted(spark_df.columns)} != {columns}"
    ours = {name: TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    if ours != types:
        return f"types {ours} != {types}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    have = sorted((tuple(r) for r in spark_df.select(*[f"`{c}`" for c in columns]).collect()), key=_key)
    if len(want) != len(have):
        return f"{len(have)} rows, expected {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
