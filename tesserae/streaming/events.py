"""Event logs as streams: windows, late data, deduplication, state with timers.

Every job here runs over what has arrived (``availableNow``) and ends, or
continuously with another trigger; results go to tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.shared import new_path

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_stream(spark: SparkSession, sf_dir: str, delay: str) -> DataFrame:
    """The event log as a stream with event time in ``at`` and a watermark."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 16).parquet(f"{sf_dir}/events.parque[t]")  # a pattern: the table may be one file
    return rows.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)


def run_append(rows: DataFrame, tag: str) -> DataFrame:
    """Run to the end of what is there, appending; the written table."""
    spark = rows.sparkSession
    path = new_path(spark, tag)
    rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def run_complete(rows: DataFrame, tag: str) -> DataFrame:
    """Run to the end, each batch replacing the table; the last table."""
    spark = rows.sparkSession
    path = new_path(spark, tag)

    last: list[int] = []

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number:010d}")
        last[:] = [number]

    rows.writeStream.foreachBatch(replace).outputMode("complete").option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/{last[0]:010d}") if last else spark.createDataFrame([], rows.schema)


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by day and type, all windows kept."""
    rows = events_stream(spark, sf_dir, "40 days").groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return run_complete(rows.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n"), "stream-days")


def closed_windows(spark: SparkSession, sf_dir: str, delay: str = "1 hour") -> DataFrame:
    """Six-hour windows that the watermark has closed; later rows are left out, open windows wait."""
    rows = events_stream(spark, sf_dir, delay).groupBy(F.window("at", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("peak"))
    return run_append(rows.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "peak"), "stream-closed")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each user and hour, the state bounded by the watermark."""
    rows = events_stream(spark, sf_dir, "40 days").withColumn("hour", F.date_trunc("hour", "at"))
    return run_append(rows.dropDuplicatesWithinWatermark(["user_id", "hour"]).select("user_id", F.col("hour").cast("timestamp_ntz").alias("hour")), "stream-distinct")


class Counters(StatefulProcessor):
    """Counters of a worker that carry on over restarts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counters", "n bigint, failed bigint, seen timestamp")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, failed, seen = self.state.get() if self.state.exists() else (0, 0, None)
        for part in rows:
            n += len(part)
            failed += int((part["event_type"] == "error").sum())
            newest = part["at"].max()
            seen = newest if seen is None or newest > pd.Timestamp(seen) else seen
        self.state.update((n, failed, pd.Timestamp(seen).to_pydatetime()))
        yield pd.DataFrame({"shard": [key[0]], "n": [n], "failed": [failed]})

    def close(self) -> None:
        pass


def worker_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counters of each worker, kept in a state store; the newest row of each."""
    provider, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    rows = events_stream(spark, sf_dir, "40 days").withColumn("shard", F.col("user_id") % 8)
    out = rows.groupBy("shard").transformWithStateInPandas(Counters(), "shard bigint, n bigint, failed bigint", "Update", "None")
    path = new_path(spark, "stream-counters")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/b={number}")

    before = spark.conf.get(provider, None)
    spark.conf.set(provider, rocks)
    try:
        out.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start().awaitTermination()
    finally:  # the session keeps its own provider
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    done = spark.read.schema("shard bigint, n bigint, failed bigint, batch int").parquet(path)
    return done.groupBy("shard").agg(F.max_by("n", "batch").alias("n"), F.max_by("failed", "batch").alias("failed"))


JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"tumbling": tumbling, "closed_windows": closed_windows, "deduplicated": deduplicated, "worker_counters": worker_counters}
