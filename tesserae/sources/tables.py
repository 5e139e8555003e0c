"""Readers for the engine's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, lazily; Spark prunes its columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"no table is named {name}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a declared schema; lines that don't parse give rows of nulls and are left out."""
    rows = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where("_bad is null").drop("_bad")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, modified, size, content)`` of files below ``path``, in whichever store it names."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")


def attach_files(meta: DataFrame, files: DataFrame) -> DataFrame:
    """Metadata rows with the path of the file that they name, or null."""
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path")
    return meta.join(named, "filename", "left")


def fingerprint(df: DataFrame, name: str, stamp: str) -> DataFrame:
    """Row count and newest stamp of a table: cheap detection of change."""
    return df.agg(F.count("*").alias("n_rows"), F.max(F.col(stamp).cast("string")).alias("newest")).select(F.lit(name).alias("name"), "n_rows", "newest")
