"""Streaming queries: the events land as files and are drained into tables; the checks are batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.sources.scratch import new_path
from chronolake.streaming import ingest, stateful

from .registry import query


def landed(spark, sf):
    return ingest.landing(spark, f"{sf}/events.parquet", "ts")


@query("str_1_append_once", "", "SELECT event_id, min(user_id) AS user_id, min(event_type) AS event_type FROM events GROUP BY event_id")
def append_once(spark, sf):
    """The events land twice, the second time after a restart; repeats go, however late."""
    path, out = new_path(spark, "landing"), new_path(spark, "stream")
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    for part in (rows, rows.where("event_id % 10 = 0")):
        part.write.mode("append").parquet(path)
        kept, _ = ingest.append_once(ingest.landing(spark, path), out, "event_id")
    return kept.select("event_id", "user_id", "event_type")


@query("str_2_first_observation", "", "SELECT event_type, CAST(ts AS DATE) AS session, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_observed FROM events WHERE value > 10 GROUP BY ALL")
def first_observation(spark, sf):
    rows = landed(spark, sf).withColumn("session", F.col("ts").cast("date"))
    out = ingest.upsert(ingest.first_observation(rows, ["event_type", "session"], "ts", F.col("value") > 10), new_path(spark, "stream"), ["event_type", "session"])
    return out.withColumn("first_observed", F.date_format("first_observed", "yyyy-MM-dd HH:mm:ss"))


#: A capture before 15:00 belongs to the session of the day before; here every day is a session.
TIMING_SQL = """c AS (SELECT event_id, {ts} AS t0, CASE WHEN strftime({ts}, '%H:%M:%S') < '15:00:00' THEN CAST({ts} AS DATE) - 1 ELSE CAST({ts} AS DATE) END AS session FROM events)
SELECT event_id, CASE WHEN t0 <= session + 1 + TIME '05:30:00' THEN 'PREOPEN_BEFORE_FORMER_0530_SLA' WHEN t0 <= session + 1 + TIME '08:45:00' THEN 'LATE_PREOPEN_BEFORE_SHADOW_DECISION_CUTOFF' WHEN t0 < session + 1 + TIME '09:30:00' THEN 'POST_CUTOFF_PRE_EXECUTION_LATE_RECOVERY' ELSE 'POST_EXECUTION_LATE_RECOVERY' END AS timing, t0 <= session + 1 + TIME '08:45:00' AS eligible FROM c"""


def timed(rows):
    """event_id, timing, eligible of rows with a local time at."""
    day = F.col("at").cast("date")
    session = F.when(F.date_format("at", "HH:mm:ss") < "15:00:00", F.date_sub(day, 1)).otherwise(day)
    c = ingest.capture_class(F.col("at"), session, F.date_add(session, 1))
    return rows.select("event_id", c.alias("c")).select("event_id", "c.timing", "c.eligible")


@query("str_3_late_classes", "", "WITH " + TIMING_SQL.replace("{ts}", "ts"))
def late_classes(spark, sf):
    rows = landed(spark, sf).select("event_id", F.col("ts").cast("timestamp_ntz").alias("at"))
    return ingest.drain(timed(rows), new_path(spark, "stream"))


@query("str_4_session_readiness", "", "SELECT CAST(ts AS DATE) AS session, array_to_string(list_filter(['click', 'purchase', 'error', 'never'], lambda x: list_contains(list(DISTINCT event_type), x)), ',') AS arrived, array_to_string(list_filter(['click', 'purchase', 'error', 'never'], lambda x: NOT list_contains(list(DISTINCT event_type), x)), ',') AS missing, false AS ready FROM events GROUP BY 1")
def session_readiness(spark, sf):
    out = ingest.readiness(landed(spark, sf), F.col("ts").cast("date"), "event_type", ["click", "purchase", "error", "never"])
    return ingest.upsert(out, new_path(spark, "stream"), ["session"])


@query("str_5_failure_breaker", "", "SELECT user_id, 'code ' || CASE WHEN event_id >= 100000 THEN '<id>' ELSE '1' END AS signature, count(*) AS failures, count(*) >= 3 AS stop FROM events WHERE event_type = 'error' GROUP BY ALL")
def failure_breaker(spark, sf):
    rows = landed(spark, sf).where("event_type = 'error'")
    signature = S.failure_signature(F.concat(F.lit("code "), F.when(F.col("event_id") >= 100000, F.col("event_id").cast("string")).otherwise("1")))
    return ingest.upsert(ingest.breaker(rows, "user_id", signature), new_path(spark, "stream"), ["user_id", "signature"])


@query("str_7_event_roll_up", "", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_roll_up(spark, sf):
    out = ingest.upsert(ingest.roll_up(landed(spark, sf), "ts", "event_type", "value"), new_path(spark, "stream"), ["day", "event_type"])
    return out.select(F.col("day").cast("date").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query("str_1_conflicts", "", "SELECT DISTINCT event_id, event_type FROM events WHERE event_id % 10 = 0")
def stream_conflicts(spark, sf):
    """Later batches repeat some ids, and some of them with other values: those are conflicts, and the first stays."""
    path, out = new_path(spark, "landing"), new_path(spark, "stream")
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    changed = rows.where("event_id % 10 = 0").withColumn("event_type", F.lit("changed"))
    for part in (rows, rows.where("event_id % 4 = 0"), changed):
        part.write.mode("append").parquet(path)
        kept, conflicts = ingest.append_once(ingest.landing(spark, path), out, "event_id")
    return conflicts.join(kept, "event_id").select("event_id", "event_type")


def by_days(spark, sf, columns):
    """The events as batches that land in order of time, five days each, and the stream starting again for each; a last row ends all sessions."""
    path = new_path(spark, "landing")
    rows = spark.read.parquet(f"{sf}/events.parquet").select(*columns, F.col("ts").cast("timestamp").alias("ts"))
    last = rows.agg(F.max("ts").alias("t")).first()["t"]
    first = rows.agg(F.min("ts").alias("t")).first()["t"]
    edges = [first + (last - first) * k / 3 for k in (1, 2)]
    end = rows.limit(1).select(*(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns), (F.lit(last) + F.expr("interval 400 days")).alias("ts"))
    parts = [rows.where(F.col("ts") <= edges[0]), rows.where((F.col("ts") > edges[0]) & (F.col("ts") <= edges[1])), rows.where(F.col("ts") > edges[1]), end]
    for part in parts:
        part.write.mode("append").parquet(path)
        yield ingest.landing(spark, path, "ts")


@query("str_2_first_complete_attempt", "", """WITH a AS (SELECT event_type AS source, CAST(ts AS DATE) AS session, ts, value > 90 AS ok, CAST(ts AS DATE) AS d FROM events), f AS (SELECT source, session, min(ts) FILTER (ok) AS first_at FROM a GROUP BY ALL)
SELECT source, session, CASE WHEN first_at IS NULL THEN 'NEVER_COMPLETE' ELSE 'COMPLETE' END AS outcome, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_at FROM f""")
def first_complete_attempt(spark, sf):
    """Sources that fail most of the time; each session is told once, when it is first complete or has ended without."""
    out = new_path(spark, "stream")
    for stream in by_days(spark, sf, ["event_type", "value"]):
        source = stream.withColumn("event_type", F.coalesce("event_type", F.lit("end")))
        rows = ingest.drain(stateful.first_observations(source, "event_type", "ts", F.col("value") > 90), out)
    return rows.where("source <> 'end'").select("source", "session", "outcome", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("first_at"))


@query("str_5_trips", "", """WITH a AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'code ' || event_id % 2 END AS signature FROM events),
g AS (SELECT *, count(*) FILTER (changed) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR) AS run FROM (SELECT *, signature IS DISTINCT FROM lag(signature) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR) OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR) > INTERVAL 365 DAY AS changed FROM a)),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id::VARCHAR) AS n FROM g WHERE signature IS NOT NULL)
SELECT user_id::VARCHAR AS unit, signature, strftime(ts, '%Y-%m-%d %H:%M:%S') AS tripped_at, n FROM n WHERE n = 2""")
def breaker_trips(spark, sf):
    """Two failures of one kind in a row trip the breaker; the runs go on over restarts."""
    out = new_path(spark, "stream")
    for stream in by_days(spark, sf, ["user_id", "event_id", "event_type"]):
        signature = F.when(F.col("event_type") == "error", F.concat(F.lit("code "), (F.col("event_id") % 2).cast("string")))
        rows = ingest.drain(stateful.trips(stream.where("user_id is not null"), "user_id", "ts", signature, "event_id", 2, quiet_days=365), out)
    return rows.select("unit", "signature", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("tripped_at"), "n")


@query("str_1_first_rows", "", """SELECT event_id, event_type, 'KEPT' AS outcome FROM events UNION ALL SELECT event_id, 'changed', 'CONFLICT' FROM events WHERE event_id % 10 = 0""")
def first_rows(spark, sf):
    """The events, then repeats of some, then some with another type: state tells them apart without reading what came before."""
    path, out = new_path(spark, "landing"), new_path(spark, "stream")
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    for part in (rows, rows.where("event_id % 4 = 0"), rows.where("event_id % 10 = 0").withColumn("event_type", F.lit("changed"))):
        part.write.mode("append").parquet(path)
        found = ingest.drain(stateful.first_rows(ingest.landing(spark, path), "event_id"), out)
    return found
