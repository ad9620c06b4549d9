"""Streaming queries over the ``events`` table read as a file stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkfold.plans.registry import query, table
from sparkfold.session import scratch_path
from sparkfold.sources.linelog import stream_lines
from sparkfold.streaming.windows import (dedup_stream, interval_join, read_stream_table, run_available_now, run_to_end, window_counts,
                                         windowed_spread, write_report_batch)

_WINDOW_ORACLE = """
WITH e AS (SELECT ts, event_type, value, time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events),
w AS (SELECT b AS window_start, event_type, value FROM e
      UNION ALL SELECT b - INTERVAL 30 MINUTE, event_type, value FROM e),
lim AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
       max(value) AS max_value, min(value) AS min_value
FROM w, lim WHERE window_start + INTERVAL 1 HOUR <= wm
GROUP BY window_start, event_type
"""


@query("stream_window_counts", oracle=_WINDOW_ORACLE)
def stream_window_counts(spark: SparkSession, sf_dir: str):
    """ST1 ST2 ST6: 1 h windows sliding by 30 min, 1 h watermark, append."""
    s = read_stream_table(spark, sf_dir, "events")
    agg = window_counts(s, "ts", "event_type", "value", "1 hour", "30 minutes", "1 hour")
    return run_available_now(spark, agg, "stream-window-counts")


_RETWEET_STREAM_ORACLE = """
WITH e AS (SELECT ts, user_id AS id, event_type AS language_code, props AS text, trunc(value)::BIGINT AS c,
                  time_bucket(INTERVAL 30 MINUTE, ts) AS b
           FROM events WHERE event_type <> 'signup'),
w AS (SELECT b - k * INTERVAL 30 MINUTE AS ws, e.* FROM e, range(0, 12) r(k)),
lim AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM e),
g AS (SELECT ws, id, language_code, text, min(c) AS mn, max(c) AS mx, count(*) AS n
      FROM w GROUP BY ws, id, language_code, text),
f AS (SELECT g.* FROM g, lim WHERE ws + INTERVAL 6 HOUR <= wm AND ws >= (SELECT min(ts) FROM e)),
ids AS (SELECT ws, id, max(mx) - min(mn) + 1 AS rc FROM f GROUP BY ws, id),
j AS (SELECT f.*, ids.rc FROM f JOIN ids USING (ws, id)),
tot AS (SELECT ws, language_code, sum(rc * n) AS total FROM j GROUP BY ws, language_code)
SELECT ws AS window_start, ws + INTERVAL 6 HOUR AS window_end, id, language_code, text,
       mn AS min_count, mx AS max_count, n, rc AS retweet_count, total::BIGINT AS total_retweets_in_lang,
       language_code AS language
FROM j JOIN tot USING (ws, language_code)
"""


_SIZE, _SLIDE = 6 * 3600, 30 * 60         # seconds


def _retweet_windows(spark: SparkSession, sf_dir: str):
    s = read_stream_table(spark, sf_dir, "events")
    rt = s.where(F.col("event_type") != "signup").select(
        "ts", F.col("user_id").alias("id"), F.col("event_type").alias("language_code"),
        F.col("props").alias("text"), F.col("value").cast("bigint").alias("count"))
    return windowed_spread(rt, "ts", "id", "language_code", "count", "text", _SIZE, _SLIDE, "1 hour")


@query("stream_retweets", oracle=_RETWEET_STREAM_ORACLE)
def stream_retweets(spark: SparkSession, sf_dir: str):
    """ST3 ST4 ST5 P5 P6 A4 A5 J2 J3 O3 K2: 6 h window sliding by 30 min;
    per id spread, per language total weighted by rows, written per
    micro-batch; windows starting before the first event are not reported."""
    agg = _retweet_windows(spark, sf_dir)
    out = run_available_now(spark, agg, "stream-retweets",
                            lambda path: write_report_batch(path, "id", "language_code", "text", _SIZE, _SLIDE))
    return out.drop("batch")


@query("stream_dedup", oracle="SELECT DISTINCT event_id, ts, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str):
    """ST7: the event stream read twice and de-duplicated on event_id within
    a 1 h watermark."""
    a = read_stream_table(spark, sf_dir, "events")
    b = read_stream_table(spark, sf_dir, "events")
    d = dedup_stream(a.unionByName(b), "ts", "event_id", "1 hour")
    out = run_available_now(spark, d.select("event_id", "ts", "user_id", "event_type"), "stream-dedup")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_retweet_log", oracle=_RETWEET_STREAM_ORACLE.replace("SELECT ws AS window_start", """
SELECT (epoch_us(ws + INTERVAL 6 HOUR) - (SELECT epoch_us(min(ts)) FROM e)) // 1000000 AS elapsed_seconds, ws AS window_start"""))
def stream_retweet_log(spark: SparkSession, sf_dir: str):
    """K2 ST5: the same windows with the seconds elapsed since the first event of the stream."""
    out = run_available_now(spark, _retweet_windows(spark, sf_dir), "stream-retweet-log",
                            lambda path: write_report_batch(path, "id", "language_code", "text", _SIZE, _SLIDE, elapsed="elapsed_seconds"))
    return out.drop("batch")


@query("stream_interval_join", oracle="""
SELECT a.event_id AS view_id, b.event_id AS click_id, a.user_id, a.ts AS viewed, b.ts AS clicked
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR
WHERE a.event_type = 'view' AND b.event_type = 'click'
""")
def stream_interval_join(spark: SparkSession, sf_dir: str):
    """Two streams joined: the clicks of a user with the views of the hour before."""
    a = read_stream_table(spark, sf_dir, "events").where("event_type = 'view'")
    b = read_stream_table(spark, sf_dir, "events").where("event_type = 'click'")
    pairs = interval_join(a.select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed")),
                          b.select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked")),
                          "user_id", "viewed", "clicked", 3600, "1 hour")
    out = run_available_now(spark, pairs, "stream-interval-join")
    return out.withColumn("viewed", F.col("viewed").cast("timestamp_ntz")).withColumn("clicked", F.col("clicked").cast("timestamp_ntz"))


@query("stream_log_source", oracle="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_log_source(spark: SparkSession, sf_dir: str):
    """S8 ST1: events written as logs of JSON lines and read by the live source in bounded micro-batches."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    root = scratch_path(spark, "event-log")
    (e.repartitionByRange(4, "ts").select(F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
     .write.text(f"{root}/log"))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in e.schema)
    lines = stream_lines(spark, f"{root}/log", max_bytes=256 << 20, split_bytes=16 << 20)
    rows = lines.select(F.from_json("value", shape, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "mode": "FAILFAST"}).alias("e")).select("e.*")
    return run_to_end(spark, rows, f"{root}/out", f"{root}/checkpoint")
