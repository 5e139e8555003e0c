"""Streaming jobs run over the event log to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..streaming import events
from .catalog import query


@query("stream_tumbling", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day windows of a stream in complete mode."""
    return events.tumbling(spark, sf_dir)


@query("stream_deduplicated", "SELECT DISTINCT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS hour FROM events")
def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each user and hour."""
    return events.deduplicated(spark, sf_dir)


@query("stream_worker_counters", "SELECT user_id % 8 AS shard, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def stream_worker_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters kept in state."""
    return events.worker_counters(spark, sf_dir)


@query("stream_closed_windows")
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark has closed; what is open depends on arrival, so SQL has no twin."""
    return events.closed_windows(spark, sf_dir)
