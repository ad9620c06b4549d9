"""Structured Streaming operators (ST1-ST7, A4, A5, J2, J3, O3, K2, P5, P6).

* ``window_counts``: event-time sliding windows with a watermark, append mode
  (a window is emitted once, when the watermark passes its end).
* ``windowed_spread`` + ``write_report_batch``: the retweet statistics of a
  sliding window.  The only stateful stage is one aggregate per window, which
  says when a window closes.  Its rows per (window, id, group, carry) with
  min / max / row count, the per-id spread and the per-group totals are
  computed batch-side in ``foreachBatch`` from the events kept so far, with
  plain aggregates and joins -- no stream-stream join.
* ``dedup_stream``: ``dropDuplicatesWithinWatermark`` on an id column.
* ``run_available_now``: drive a streaming query over everything available
  (fresh checkpoint under the shared checkpoint root) and hand back the sink
  as a static DataFrame.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.functions.langnames import with_language_name
from sparkfold.functions.text import strip_newlines
from sparkfold.session import is_directory, path_exists, remove_path, scratch_path


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def window_counts(stream: DataFrame, ts: str, key: str, value: str, size: str, slide: str,
                  delay: str) -> DataFrame:
    """Sliding event-time windows per key with a watermark: rows, max and min value (append mode)."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    agg = (s.groupBy(F.window(ts, size, slide).alias("w"), key)
           .agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("max_value"), F.min(value).alias("min_value")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), key, "n", "max_value", "min_value")


def windowed_spread(stream: DataFrame, ts: str, id_col: str, group: str, count: str, carry: str,
                    size: int, slide: int, delay: str) -> DataFrame:
    """The stream of ``write_report_batch``: a row for each event, in its pane, and a row for each closed window.

    The stateful stage holds one row per window (its first event time), not one per window and event: ``size / slide``
    windows hold an event, and its state would be as many times the input.  Windows of ``size`` seconds that start every
    ``slide`` seconds are made of whole panes, as long as the greatest common divisor of both (start in microseconds)."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    closed = (s.groupBy(F.window(ts, f"{size} seconds", f"{slide} seconds").alias("w")).agg(F.min(ts).alias("first_ts"))
              .select(F.unix_micros("w.start").alias("_start"), F.col("first_ts").cast("timestamp_ntz").alias("first_ts")))
    pane = math.gcd(size, slide) * 1_000_000
    events = (event_time(stream, ts).where(F.col(ts).isNotNull())
              .select(_slot(F.unix_micros(ts), pane).alias("_pane"), id_col, group, carry, F.col(count).alias("_count")))
    return events.unionByName(closed, allowMissingColumns=True)


def _slot(micros: Column, length: int) -> Column:
    """The last multiple of ``length`` up to ``micros``."""
    return micros - F.pmod(micros, F.lit(length))


def window_rows(events: DataFrame, closed: DataFrame, id_col: str, group: str, carry: str, size: int, slide: int) -> DataFrame:
    """Per (window, id, group, carry) min / max count and rows of the ``closed`` windows (``_start``).

    Events are summed up by pane, and panes shuffled by id and by block, ``size`` seconds of window starts: a pane is in two
    blocks at most, and its windows are made where it lies.  All windows of an id in one block are in one task (``_block`` stays
    with the rows), so an id with most of the events is as many pieces as there are blocks."""
    key = [id_col, group, carry]
    span, step = size * 1_000_000, slide * 1_000_000
    last = _slot(F.col("_pane"), step)                                      # the windows of a pane start at first, ..., last
    first = _slot(F.col("_pane") - span, step) + step
    block = F.sequence(_slot(first, span), _slot(last, span), F.lit(span))
    panes = (events.groupBy("_pane", *key).agg(F.min("_count").alias("_mn"), F.max("_count").alias("_mx"), F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
             .withColumn("_block", F.explode(block)).repartition("_block", id_col))
    begin = F.greatest("_first", _slot(F.col("_block") + F.lit(step - 1), step))
    upto = F.least("_last", F.col("_block") + F.lit(span - 1))
    windows = (panes.where(begin <= upto).withColumn("_start", F.explode(F.sequence(begin, upto, F.lit(step))))
               .join(F.broadcast(closed.select("_start")), "_start"))        # a row per window, whatever the number of events
    rows = windows.groupBy("_block", "_start", *key).agg(F.min("_mn").alias("min_count"), F.max("_mx").alias("max_count"), F.sum("_n").alias("n"))
    return rows.select("_block", F.timestamp_micros("_start").cast("timestamp_ntz").alias("window_start"),
                       F.timestamp_micros(F.col("_start") + F.lit(span)).cast("timestamp_ntz").alias("window_end"),
                       *key, "min_count", "max_count", "n")


def window_spreads(batch: DataFrame, id_col: str, count_col: str = "retweet_count") -> DataFrame:
    """The spread per (window, id) beside every row; ids that are null have none and go.  (``_block``: see ``window_rows``.)"""
    wk = [c for c in ("_block", "window_start", "window_end") if c in batch.columns]
    same = Window.partitionBy(*wk, id_col)
    return (batch.where(F.col(id_col).isNotNull())
            .withColumn(count_col, F.max("max_count").over(same) - F.min("min_count").over(same) + 1).drop("_block"))


def window_totals(rows: DataFrame, group: str, total_col: str = "total_retweets_in_lang", count_col: str = "retweet_count") -> DataFrame:
    """Group total = sum(spread x rows) per (window, group) -- a tweet seen k times adds k x its count; sorted output."""
    wk = ["window_start", "window_end"]
    totals = rows.groupBy(*wk, group).agg(F.sum(F.col(count_col) * F.col("n")).alias(total_col))
    return (rows.join(totals, [*wk, group])
            .orderBy(*wk, F.desc(total_col), F.desc(count_col)))


def finish_windows(batch: DataFrame, id_col: str, group: str, total_col: str = "total_retweets_in_lang",
                   count_col: str = "retweet_count") -> DataFrame:
    """Batch side of closed windows (A4 A5 J2 J3 O3): spread per (window, id), total per (window, group), sorted."""
    return window_totals(window_spreads(batch, id_col, count_col), group, total_col, count_col)


def write_report_batch(path: str, id_col: str, group: str, carry: str, size: int, slide: int,
                       warm_up: bool = True, elapsed: str | None = None) -> Callable[[DataFrame, int], None]:
    """K2 ST5: ``foreachBatch`` writer for ``windowed_spread``; one folder per batch id,
    overwritten on a retry, so a replayed batch never duplicates rows.

    A batch's events are kept beside the output (``_events``) until the windows
    that hold them have closed; a window is made in the batch that closes it, of
    all events that came up to then.  An event that came after its window closed
    counts in those of its windows that were still open.

    Warm-up: windows that start before the first event of the stream saw
    only part of their span and are not reported.  Windows close in event
    time order, so the first batch with rows holds the earliest event; its
    time is kept as one small marker table beside the output (written once,
    read by every later batch).  ``elapsed`` names a column for the whole
    seconds from that first event to the end of the window."""
    marker, kept, spreads = f"{path}/_first_event", f"{path}/_events", f"{path}/_spreads"

    def drop_closed(spark: SparkSession, shape, batch_id: int) -> None:
        """Remove kept batches of which no window was open before this batch (so that it can be replayed)."""
        ends = (spark.read.schema(shape).parquet(kept).where(F.col("_at") < batch_id).groupBy("_at")
                .agg(F.max("_pane").alias("pane"), F.max("_start").alias("closed")).collect())     # a row per kept batch
        opens = max((r["closed"] + slide * 1_000_000 for r in ends if r["closed"] is not None), default=None)
        for r in ends:
            if opens is not None and r["_at"] < batch_id - 1 and (r["pane"] is None or r["pane"] < opens):
                remove_path(spark, f"{kept}/_at={r['_at']}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # written once: the stateful stage runs once for all uses below, and later windows need these events
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{kept}/_at={batch_id}")
        shape = T.StructType([*batch.schema.fields, T.StructField("_at", T.LongType())])
        if batch_id:
            drop_closed(spark, shape, batch_id)
        rows = spark.read.schema(shape).parquet(kept)
        closed = rows.where((F.col("_at") == batch_id) & F.col("_start").isNotNull())
        t0 = None
        if warm_up or elapsed:
            # a marker counts once it is complete; any other failure to read it is an error
            if not path_exists(spark, f"{marker}/_SUCCESS"):
                earliest = closed.agg(F.min("first_ts").alias("t0"))
                if earliest.first()["t0"] is not None:
                    earliest.write.mode("overwrite").parquet(marker)
            if path_exists(spark, f"{marker}/_SUCCESS"):
                t0 = spark.read.schema("t0 timestamp_ntz").parquet(marker).first()["t0"]
                if warm_up:
                    closed = closed.where(F.timestamp_micros("_start").cast("timestamp_ntz") >= F.lit(t0))
        bounds = closed.agg(F.min("_start").alias("lo"), F.max("_start").alias("hi")).first()
        lo, hi = bounds["lo"] or 0, (bounds["hi"] or 0) + size * 1_000_000
        events = rows.where((F.col("_at") <= batch_id) & (F.col("_pane") >= lo) & (F.col("_pane") < hi))
        spread = window_spreads(window_rows(events, closed, id_col, group, carry, size, slide), id_col)
        # read for the totals, for the ranges of the sort and for the sort itself
        spread.write.mode("overwrite").option("compression", "zstd").parquet(spreads)
        out = window_totals(spark.read.schema(spread.schema).parquet(spreads), group)
        out = with_language_name(out, group).withColumn(carry, strip_newlines(F.col(carry)))
        if elapsed:
            since = F.unix_micros(F.col("window_end").cast("timestamp")) - F.unix_micros(F.lit(t0).cast("timestamp_ntz").cast("timestamp"))
            out = out.withColumn(elapsed, F.floor(since / 1_000_000))
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def start_live(stream: DataFrame, sink_path: str, checkpoint: str, every: str = "5 seconds",
               foreach_batch: Callable[[str], Callable] | None = None):
    """ST1 ST6: run continuously with a processing-time trigger (the micro-
    batch clock); returns the StreamingQuery handle."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(processingTime=every))
    if foreach_batch is None:
        return w.format("parquet").option("path", sink_path).start()
    return w.foreachBatch(foreach_batch(sink_path)).start()


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: int, delay: str) -> DataFrame:
    """J2 J3 as a join of two streams: every ``right`` row with the ``left`` rows of its key of the ``within`` seconds up to it.

    -> all columns of ``left``, and those of ``right`` but for the key; the other names must differ.  Both sides wait for the watermark
    (``delay``), and the bound on times lets Spark drop rows that no later row can meet.  The join is also on a slice of
    time of ``within`` seconds (a right row asks for its own slice and the one before), so a key with a third of all rows is many
    groups, each bounded by its slice, and a pair is found once.  Null keys and times join with nothing."""
    if within <= 0:
        raise ValueError("within must be positive")
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")

    def slice_of(ts: str):
        return F.floor(F.unix_micros(F.col(ts)) / (within * 1_000_000))
    a = event_time(left, left_ts).where(F.col(key).isNotNull()).withWatermark(left_ts, delay).withColumn("_slice_l", slice_of(left_ts))
    b = event_time(right, right_ts).where(F.col(key).isNotNull()).withWatermark(right_ts, delay)
    b = (b.withColumnRenamed(key, "_key_r").withColumn("_slice_r", F.explode(F.array(slice_of(right_ts), slice_of(right_ts) - 1))))
    near = ((F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within} SECONDS")))
    return a.join(b, (F.col(key) == F.col("_key_r")) & (F.col("_slice_l") == F.col("_slice_r")) & near).drop("_key_r", "_slice_l", "_slice_r")


def dedup_stream(stream: DataFrame, ts: str, key: str, delay: str) -> DataFrame:
    """Drop repeated ``key`` values within the watermark delay."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_available_now(spark: SparkSession, stream: DataFrame, name: str,
                      foreach_batch: Callable[[str], Callable] | None = None) -> DataFrame:
    """Run a streaming query over all available input into a fresh sink; return the sink as a DataFrame."""
    root = scratch_path(spark, name)
    out, ckpt = f"{root}/out", f"{root}/checkpoint"
    w = stream.writeStream.option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True)
    if foreach_batch is None:
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(foreach_batch(out)).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if not path_exists(spark, out):             # no input, no batch: an empty result of the same columns
        empty = spark.createDataFrame([], stream.schema)
        if foreach_batch is None:
            return empty
        foreach_batch(out)(empty, 0)
    # "_"-prefixed folders (kept events, the warm-up marker) are skipped by the file listing
    return spark.read.parquet(out)


def run_to_end(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run micro-batches until the source has nothing more, and stop; a further call with the same folders goes on from the checkpoint.
    (Sources with admission control need it: an available-now trigger takes one offset only.)"""
    q = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").format("parquet").option("path", out).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(stream.schema).parquet(out)


def read_stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream one table (``<name>.parquet``, a file or a directory of part files) of a folder."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_directory(spark, path):
        return stream.parquet(path)
    # a file stream watches a folder: of a single file, its folder and nothing but the file
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
