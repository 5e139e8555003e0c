"""Run operations over event logs: ledgers, liveness, funnels, windows, interview rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import tables
from ..sources.tables import read
from .catalog import query

_LEDGER = "WITH e AS (SELECT event_id, ts, user_id % 8 AS shard, user_id AS label, event_type AS status, value FROM events)\n"
NOW = "2024-02-01 00:00:00"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ledger rows of eight shards."""
    return read(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") % 8).alias("shard"), F.col("user_id").alias("label"), F.col("event_type").alias("status"), "value")


@query("newest_ledger_row", _LEDGER + "SELECT label, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(status, (ts, event_id)) AS status FROM e GROUP BY label")
def newest_ledger_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each document; of equal times the later one."""
    return tables.latest(ledger(spark, sf_dir).select("label", "event_id", "ts", "status"), ["label"], ["ts", "event_id"])


@query("newest_topology", _LEDGER + ", g AS (SELECT label % 3 + 6 AS declared, shard, max(ts) AS updated FROM e GROUP BY ALL), b AS (SELECT arg_max(declared, (u, declared)) AS declared FROM (SELECT declared, max(updated) AS u FROM g GROUP BY declared)) SELECT declared, shard, updated FROM g WHERE declared = (SELECT declared FROM b) AND shard < declared")
def newest_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the layout that was updated last; those outside it are dropped."""
    g = ledger(spark, sf_dir).groupBy((F.col("label") % 3 + 6).alias("declared"), "shard").agg(F.max("ts").alias("updated"))
    best = g.agg(F.max_by("declared", F.struct("updated", "declared")).alias("declared"))
    return g.join(F.broadcast(best), "declared", "left_semi").where("shard < declared").select("declared", "shard", "updated")


_STATE = _LEDGER + f"""
, w AS (SELECT shard, min(ts) AS started, max(ts) AS seen, count(*) AS n, count(*) FILTER (status = 'error') AS n_failed, arg_max(status, (ts, event_id)) AS last FROM e GROUP BY shard),
s AS (SELECT *, CASE WHEN last = 'purchase' THEN 'complete' WHEN last = 'error' THEN 'interrupted' WHEN seen < TIMESTAMP '{NOW}' - INTERVAL 50 HOUR THEN 'stale' WHEN last = 'logout' THEN 'stopping' ELSE 'running' END AS state FROM w)
"""


def worker_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ledger(spark, sf_dir).groupBy("shard").agg(F.min("ts").alias("started"), F.max("ts").alias("seen"), F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("n_failed"), F.max_by("status", F.struct("ts", "event_id")).alias("last"))
    silent = F.col("seen") < F.expr(f"timestamp_ntz '{NOW}' - interval 50 hours")
    state = F.when(F.col("last") == "purchase", "complete").when(F.col("last") == "error", "interrupted").when(silent, "stale").when(F.col("last") == "logout", "stopping").otherwise("running")
    return w.withColumn("state", state)


@query("worker_state", _STATE + "SELECT shard, n, n_failed, last, state FROM s")
def worker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of each worker at a given time: complete, interrupted, stale, stopping, running."""
    return worker_states(spark, sf_dir).select("shard", "n", "n_failed", "last", "state")


@query("run_summary", _STATE + "SELECT CAST(sum(n) AS BIGINT) AS n_done, CAST(sum(n_failed) AS BIGINT) AS n_failed, max(n) AS largest, min(started) AS started, max(seen) AS updated, CASE WHEN bool_or(state IN ('running', 'stopping')) THEN 'running' WHEN bool_and(state = 'complete') THEN 'complete' WHEN bool_and(state IN ('complete', 'interrupted')) THEN 'interrupted' ELSE 'stalled' END AS state FROM s")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, maxima and the run's state from its workers'."""
    live, done = F.col("state").isin("running", "stopping"), F.col("state") == "complete"
    state = F.when(F.bool_or(live), "running").when(F.bool_and(done), "complete").when(F.bool_and(done | (F.col("state") == "interrupted")), "interrupted").otherwise("stalled")
    return worker_states(spark, sf_dir).agg(F.sum("n").alias("n_done"), F.sum("n_failed").alias("n_failed"), F.max("n").alias("largest"), F.min("started").alias("started"), F.max("seen").alias("updated"), state.alias("state"))


@query("stage_funnel", _LEDGER + ", l AS (SELECT label, count(DISTINCT status) AS stages, bool_or(status = 'error') AS failed FROM e GROUP BY label) SELECT stages, failed, count(*) AS n_jobs FROM l GROUP BY ALL")
def stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs by how many stages they have reached."""
    l = ledger(spark, sf_dir).groupBy("label").agg(F.count_distinct("status").alias("stages"), F.bool_or(F.col("status") == "error").alias("failed"))  # noqa: E741
    return l.groupBy("stages", "failed").agg(F.count("*").alias("n_jobs"))


@query("percent_done", _LEDGER + ", l AS (SELECT shard, status, least(1.0::DOUBLE, count(*) / 300.0::DOUBLE) AS done FROM e GROUP BY ALL) SELECT shard, round(100 * avg(done), 4) AS percent FROM l GROUP BY shard")
def percent_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean progress over stages, each capped at its total."""
    l = ledger(spark, sf_dir).groupBy("shard", "status").agg(F.least(F.lit(1.0), F.count("*") / F.lit(300.0)).alias("done"))  # noqa: E741
    return l.groupBy("shard").agg(F.round(100 * F.avg("done"), 4).alias("percent"))


@query("retry_markers", _LEDGER + "SELECT DISTINCT label FROM e WHERE status = 'purchase' AND label NOT IN (SELECT label FROM e WHERE status = 'error' AND value > 90) AND label % 11 <> 3")
def retry_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What counts as done: finished, not marked for another try, not given up."""
    e = ledger(spark, sf_dir)
    retry = e.where("status = 'error' and value > 90").select("label")
    return e.where("status = 'purchase' and label % 11 <> 3").select("label").distinct().join(retry, "label", "left_anti")


@query("open_calls", _LEDGER + ", o AS (SELECT label, min(ts) AS opened FROM e WHERE status = 'login' GROUP BY label), c AS (SELECT label, max(ts) AS closed FROM e WHERE status = 'logout' GROUP BY label), l AS (SELECT e.label, min(e.ts) AS oldest, count(*) AS n_open FROM e LEFT JOIN c USING (label) WHERE status = 'view' AND (closed IS NULL OR ts > closed) GROUP BY e.label) SELECT * FROM l")
def open_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls begun after the last end of their process."""
    e = ledger(spark, sf_dir)
    c = e.where("status = 'logout'").groupBy("label").agg(F.max("ts").alias("closed"))
    return e.where("status = 'view'").join(c, "label", "left").where("closed is null or ts > closed").groupBy("label").agg(F.min("ts").alias("oldest"), F.count("*").alias("n_open"))


@query("shard_rates", _LEDGER + "SELECT shard, count(*) AS n, CAST(date_diff('second', min(ts), max(ts)) AS BIGINT) > 0 AS moving, round(count(*) / greatest(1, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0), 4) AS per_hour FROM e GROUP BY shard")
def shard_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by hour of each shard."""
    us = F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))
    return ledger(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), (us > 0).alias("moving"), F.round(F.count("*") / F.greatest(F.lit(1.0), us / 3600000000.0), 4).alias("per_hour"))


@query("tumbling_events", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type."""
    rows = read(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select(F.col("w.start").alias("day"), "event_type", "n", "total")


@query("sliding_events", "WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL (6 * k) HOUR AS start, value FROM events, range(0, 4) r(k)) SELECT start, count(*) AS n, max(value) AS peak FROM w GROUP BY start")
def sliding_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-long windows that start every six hours."""
    rows = read(spark, sf_dir, "events").groupBy(F.window("ts", "24 hours", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("peak"))
    return rows.select(F.col("w.start").alias("start"), "n", "peak")


@query("session_events", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, k")
def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that end with six silent hours."""
    rows = read(spark, sf_dir, "events").select("user_id", F.col("ts")).groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("w.start").alias("started"), "n")


@query("session_history_cap", "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4")
def session_history_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last four turns of each conversation."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.row_number().over(w).alias("r")).where("r <= 4").drop("r")


@query("conversation_turn_stats", "SELECT conv_id, count(*) AS n_turns, count(*) FILTER (role = 'user') AS n_user, CAST(sum(length(text)) AS BIGINT) AS n_chars, max(length(text)) AS longest FROM conversations GROUP BY conv_id")
def conversation_turn_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and lengths of conversations."""
    n = F.length("text").cast("bigint")
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.count_if(F.col("role") == "user").alias("n_user"), F.sum(n).alias("n_chars"), F.max(n).alias("longest"))


#: Guided interview: slots are drawn from customers so that every combination occurs.
_SLOTS = "WITH s AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'DE' ELSE 'US' END AS place, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'offer' ELSE 'advise' END AS activity, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'fund' ELSE 'share' END AS category, CASE c_custkey % 7 WHEN 0 THEN NULL ELSE 'retail' END AS investor, CASE c_custkey % 2 WHEN 0 THEN NULL ELSE 'FR' END AS said FROM customer)\n"


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda m, one, rest: F.when(k % m == 0, None).when(k % m == 1, one).otherwise(rest)
    return read(spark, sf_dir, "customer").select(k.alias("id"), pick(3, "DE", "US").alias("place"), pick(4, "offer", "advise").alias("activity"), pick(5, "fund", "share").alias("category"), F.when(k % 7 != 0, "retail").alias("investor"), F.when(k % 2 != 0, "FR").alias("said"))


@query("interview_next", _SLOTS + "SELECT id, CASE WHEN place IS NULL THEN 'place' WHEN activity IS NULL THEN 'activity' WHEN category IS NULL AND activity <> 'advise' THEN 'category' WHEN investor IS NULL AND place <> 'US' THEN 'investor' ELSE 'done' END AS next FROM s")
def interview_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first question that still applies."""
    c = F.col
    ask = F.when(c("place").isNull(), "place").when(c("activity").isNull(), "activity").when(c("category").isNull() & (c("activity") != "advise"), "category").when(c("investor").isNull() & (c("place") != "US"), "investor").otherwise("done")
    return slots(spark, sf_dir).select("id", ask.alias("next"))


@query("interview_merge", _SLOTS + ", m AS (SELECT *, coalesce(said, place) AS p2 FROM s), i AS (SELECT *, CASE WHEN p2 IS DISTINCT FROM place AND p2 = 'FR' THEN NULL ELSE category END AS c2 FROM m) SELECT id, p2 AS place, c2 AS category, CASE WHEN c2 IS NULL AND category IS NOT NULL THEN NULL ELSE investor END AS investor, concat_ws('; ', CASE WHEN p2 IS DISTINCT FROM place THEN 'place is ' || p2 END, CASE WHEN c2 IS NULL AND category IS NOT NULL THEN 'category dropped' END) AS said FROM i")
def interview_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New answers over old ones, then what they make invalid, in order."""
    rows = slots(spark, sf_dir).withColumn("p2", F.coalesce("said", "place"))
    moved = ~F.col("p2").eqNullSafe(F.col("place"))
    rows = rows.withColumn("c2", F.when(~(moved & (F.col("p2") == "FR")), F.col("category")))
    gone = F.col("c2").isNull() & F.col("category").isNotNull()
    said = F.concat_ws("; ", F.when(moved, F.concat(F.lit("place is "), "p2")), F.when(gone, F.lit("category dropped")))
    return rows.select("id", F.col("p2").alias("place"), F.col("c2").alias("category"), F.when(~gone, F.col("investor")).alias("investor"), said.alias("said"))


@query("compose_question", _SLOTS + "SELECT id, 'May I ' || coalesce(activity, 'act') || CASE WHEN category IS NOT NULL THEN ' a ' || category ELSE '' END || CASE WHEN place IS NOT NULL THEN ' in ' || place ELSE '' END || '?' AS question FROM s")
def compose_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question put together from the slots that are known."""
    part = lambda word, col: F.coalesce(F.concat(F.lit(word), F.col(col)), F.lit(""))
    return slots(spark, sf_dir).select("id", F.concat(F.lit("May I "), F.coalesce("activity", F.lit("act")), part(" a ", "category"), part(" in ", "place"), F.lit("?")).alias("question"))
