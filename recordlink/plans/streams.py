"""Queries that run a stream over the event files to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlink.plans.registry import query, table
from recordlink.session import scratch_path
from recordlink.streaming import jobs


def event_stream(spark, sf):
    """The event table as a file stream; the glob lets it be one file or a folder of files."""
    return jobs.read_files(spark, f"{sf}/event[s].parquet", table(spark, sf, "events").schema)


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("stream_ingest", "SELECT event_id, user_id, ts FROM events")
def q_stream_ingest(spark, sf):
    """Two overlapping deliveries of the same events."""
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf)).select("event_id", "user_id", "ts")
    return ntz(jobs.stream_ingest(twice, "event_id", "ts", "2 days", scratch_path(spark, "ingest")), "ts")


@query(
    "stream_gap_sessions",
    """WITH g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 4 HOUR THEN 1 ELSE 0 END AS n FROM events))
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 4 HOUR AS session_end, count(*) AS parts FROM g GROUP BY user_id, s
    HAVING max(ts) + INTERVAL 4 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR""",
)
def q_stream_gap_sessions(spark, sf):
    out = jobs.stream_gap_sessions(event_stream(spark, sf), "user_id", "ts", "4 hours", "1 hour", scratch_path(spark, "sessions"))
    return ntz(out, "session_start", "session_end")


@query(
    "stream_failure_streak",
    """SELECT e.user_id, count(*) FILTER (event_type = 'error' AND (ok IS NULL OR (ts, event_id) > ok)) AS streak, max(ts) FILTER (event_type <> 'error') AS last_success,
      max(ts) FILTER (event_type = 'error') AS last_failure FROM events e JOIN (SELECT user_id, max((ts, event_id)) FILTER (event_type <> 'error') AS ok FROM events GROUP BY 1) USING (user_id) GROUP BY 1""",
)
def q_stream_failure_streak(spark, sf):
    ok = F.col("event_type") != "error"
    state, _ = jobs.stream_failure_streak(event_stream(spark, sf), "user_id", "ts", "event_id", ok, 2, scratch_path(spark, "streaks"))
    return ntz(state, "last_success", "last_failure")


@query(
    "stream_health_counts",
    """SELECT w AS window_start, w + INTERVAL 12 HOUR AS window_end, event_type, count(*) AS n FROM (
      SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS w FROM events) GROUP BY ALL""",
)
def q_stream_health_counts(spark, sf):
    out = jobs.stream_health_counts(event_stream(spark, sf), "ts", "event_type", "12 hours", "6 hours", "1 hour", scratch_path(spark, "health"))
    return ntz(out, "window_start", "window_end")
