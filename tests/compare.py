"""Comparison of a Spark result with a DuckDB statement on the same tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    for column in pdf.columns:
        if pdf[column].dtype != object and not pd.api.types.is_string_dtype(pdf[column]):
            pdf = pdf.assign(**{column: pd.to_numeric(pdf[column]).astype("float64")})
        else:
            pdf = pdf.assign(**{column: pdf[column].astype(object).where(pdf[column].notna(), None)})
    return pdf.sort_values(list(pdf.columns), ignore_index=True)


def assert_same(result: DataFrame, con: duckdb.DuckDBPyConnection, statement: str) -> int:
    expected = con.execute(statement).df()
    actual = result.toPandas()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert len(actual) == len(expected), (len(actual), len(expected))
    pd.testing.assert_frame_equal(canonical(actual), canonical(expected), check_dtype=False)
    return len(actual)
