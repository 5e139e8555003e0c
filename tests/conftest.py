"""One local Spark session for all tests, and the oracle comparison."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
#: How DuckDB names Spark's types.
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]", "array<bigint>": "BIGINT[]"}


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(df: pd.DataFrame) -> list[tuple]:
    """Rows as comparable text, columns by name, in any order."""

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "~"
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, list | tuple):
            return str([plain(x) for x in v])
        return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)

    return sorted(map(tuple, df[sorted(df.columns)].map(plain).values.tolist()))


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir, duck):
    """Compare a query with its oracle: columns, types and rows."""

    def compare(query, sql: str) -> int:
        found = query(spark, sf_dir)
        told = duck.sql(sql)
        kinds = dict(zip(told.columns, map(str, told.types), strict=True))
        assert {c: KINDS.get(k, k) for c, k in found.dtypes} == kinds
        rows = rows_of(found.toPandas())
        assert rows == rows_of(told.df())
        return len(rows)

    return compare
