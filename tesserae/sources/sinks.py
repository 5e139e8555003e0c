"""Sinks: partitioned indexes, upserts, versioned publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_index(rows: DataFrame, path: str) -> None:
    """Index rows by model and region, so that a scoped read opens its regions only."""
    rows.write.mode("overwrite").partitionBy("model", "region").parquet(path)


def load_index(spark: SparkSession, path: str, model: str, with_vectors: bool = True) -> DataFrame:
    """The rows that one model made; without vectors their column isn't read."""
    rows = spark.read.parquet(path).where(F.col("model") == model)
    return rows if with_vectors else rows.drop("embedding")


def save_bundles(rows: DataFrame, path: str, by: str) -> None:
    rows.write.mode("overwrite").partitionBy(by).json(path)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` in place of the rows of ``old`` with its keys; all others stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def stale(stored: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Stored rows that the current run didn't touch."""
    return stored.join(current.select(key).distinct(), key, "left_anti")


def verify_load(spark: SparkSession, path: str, expected: int) -> int:
    """Rows found at ``path``; an error if they aren't as many as expected."""
    found = spark.read.parquet(path).count()
    if found != expected:
        raise ValueError(f"{path} holds {found} rows, {expected} were written")
    return found


def publish(rows: DataFrame, root: str, version: str, stamp: str) -> None:
    """Write a version, check it, then point ``latest`` at it; readers never see half a version."""
    spark = rows.sparkSession
    path = f"{root}/version={version}"
    rows.write.mode("errorifexists").parquet(path)
    verify_load(spark, path, rows.count())
    spark.createDataFrame([(version, stamp)], "version string, stamp string").coalesce(1).write.mode("append").json(f"{root}/pointer")


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The version that the newest pointer row names."""
    rows = spark.read.schema("version string, stamp string").json(f"{root}/pointer")
    return rows.agg(F.max_by("version", F.struct("stamp", "version"))).first()[0]
