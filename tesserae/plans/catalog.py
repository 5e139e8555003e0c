"""Catalogue of the engine's named queries.

A query is a function ``(spark, sf_dir) -> DataFrame``; where plain SQL can say
the same, its text stands beside it and serves as an independent oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its oracle if there is one."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register
