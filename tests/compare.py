"""Order-insensitive comparison of a Spark query with its SQL on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or (isinstance(value, float) and pd.isna(value)) or value is pd.NA:
            return None
        return round(value, 9) if isinstance(value, float) else value

    ordered = frame[sorted(frame.columns)].astype(object)
    listed = [tuple(plain(v) for v in row) for row in ordered.itertuples(index=False)]
    return sorted(listed, key=repr)


_TYPES = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "bigint": "BIGINT",
          "boolean": "BOOLEAN", "double": "DOUBLE"}


def compare(spark_result: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> None:
    expected = connection.sql(sql)
    types = {n: _TYPES.get(t, t) for n, t in spark_result.dtypes}
    wanted = dict(zip(expected.columns, map(str, expected.types)))
    assert types == wanted, (types, wanted)
    got, want = rows(pd.DataFrame([r.asDict() for r in spark_result.collect()],
                                  columns=spark_result.columns)), rows(
        pd.DataFrame(expected.fetchall(), columns=expected.columns))
    assert len(got) == len(want), (len(got), len(want))
    for left, right in zip(got, want):
        assert left == right, (left, right)
