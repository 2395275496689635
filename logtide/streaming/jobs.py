"""The streaming jobs: click counter, hourly uniques, raw archive and its load.

Each takes a streaming DataFrame of messages (the Kafka envelope:
topic, partition, offset, timestamp, key, value) — from `read_kafka` on a
cluster, or from `stream_messages` over files in tests. Progress, totals and
commits are Spark's own: a restart resumes after the last committed batch with
that batch's state, and a batch that ran but did not commit runs again from the
same state on the same input, so nothing counts twice (see `state` for the
layout of a table and `ledger` for a readable record of the offsets).

* counter: running totals per row key in the state store, update mode. Readers
  ask the state; `on_change` also gets each batch's changed totals, absolute
  values that an external store can simply put, replayed or not.
* uniques: a session window per hour key, as long as the key's time to live and
  renewed by each write. When the watermark passes its end the session leaves
  the state and is appended to the table by the file sink.
* archive, and its load: the file sink (text or Parquet), whose own commit log
  makes its output exactly once.
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtide.functions.dates import HOUR_KEY_PATTERN
from logtide.functions.logs import csv_field
from logtide.operators import archive as A
from logtide.operators import counters as C
from logtide.operators import uniques as U
from logtide.streaming import state

# The reference's batch intervals, archive roll period and key retention.
COUNTER_TRIGGER = "5 seconds"
UNIQUES_TRIGGER = "1 second"
ARCHIVE_TRIGGER = "1 minute"
RETENTION = "1 day"

DEFAULT_WRITER = "main"


def _start(rows: DataFrame, mode: str, checkpoint: str, trigger: str | None, query_name: str | None, sink) -> StreamingQuery:
    """Start a query; `sink` completes its DataStreamWriter."""
    writer = sink(rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger == "once":
        writer = writer.trigger(once=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def click_counter_stateful(messages: DataFrame, layout: str = C.DATE_CITY) -> DataFrame:
    """(row_key, click_count): keyed running totals in Spark's state store (update or complete mode).
    State grows with the number of keys, days times cities, and never shrinks, as the reference's table."""
    return C.click_events(messages.select("value"), layout).groupBy("row_key") \
        .agg(F.count(F.lit(1)).alias("click_count"))


def click_counter_stream(spark: SparkSession, messages: DataFrame, table: str, writer: str = DEFAULT_WRITER,
                         layout: str = C.DATE_CITY, trigger: str | None = COUNTER_TRIGGER,
                         repartition: int | None = None, query_name: str | None = None,
                         on_change: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Clicks per (day, city) as running totals in the state of `table`'s writer.

    `on_change(rows, batch_id)` gets the new totals (row_key, click_count) of the keys a batch has changed, in
    `repartition` partitions if that is given."""
    state.use_state_store(spark)
    totals = click_counter_stateful(messages, layout)
    if repartition:
        totals = totals.repartition(repartition)
    return _start(totals, "update", state.checkpoint_of(table, writer), trigger, query_name,
                  lambda w: w.foreachBatch(on_change) if on_change else w.format("noop"))


def read_click_counter(spark: SparkSession, table: str) -> DataFrame:
    """(row_key, click_count): the totals of a counter table, summed over its writers."""
    rows = state.counter_rows(spark, table)
    return rows.groupBy("row_key").agg(F.sum("click_count").cast("bigint").alias("click_count"))


def user_sessions(messages: DataFrame, ttl: str = RETENTION, watermark: str = "0 seconds",
                  processing_time: bool = False, lg_k: int = U.HLL_LG_K) -> DataFrame:
    """(hour_key, begins, expires, sketch, last_write, n_rows): the uniques of an hour key from its first write until
    `ttl` has passed without another one (append mode: emitted, and dropped from the state, once the watermark is past
    `expires`)."""
    state.use_state_store(messages.sparkSession)
    writes = U.user_hours(messages, processing_time=processing_time).withWatermark("write_ts", watermark)
    sessions = writes.groupBy("hour_key", F.session_window("write_ts", ttl).alias("session")).agg(
        F.hll_sketch_agg("user_id", lg_k).alias("sketch"), F.max("write_ts").alias("last_write"),
        F.count(F.lit(1)).alias("n_rows"))
    return sessions.select("hour_key", F.col("session.start").alias("begins"), F.col("session.end").alias("expires"),
                           "sketch", "last_write", "n_rows")


def hourly_uniques_stream(spark: SparkSession, messages: DataFrame, table: str, writer: str = DEFAULT_WRITER,
                          processing_time: bool = False, trigger: str | None = UNIQUES_TRIGGER,
                          repartition: int | None = None, query_name: str | None = None,
                          ttl: str = RETENTION, watermark: str = "10 minutes") -> StreamingQuery:
    """Per-hour HLL sketches of CSV user ids; an hour lives until `ttl` after its last write.

    The hour is the message timestamp's (replayable); `processing_time=True` keys by the wall clock when the batch
    runs, as the reference does. Messages more than `watermark` behind the newest are late: Spark drops them if their
    session would have ended before the watermark."""
    sessions = user_sessions(messages, ttl, watermark, processing_time)
    if repartition:
        sessions = sessions.repartition(repartition)
    return _start(sessions, "append", state.checkpoint_of(table, writer), trigger, query_name,
                  lambda w: w.format("parquet").option("path", state.closed_of(table, writer)))


def read_sessions(spark: SparkSession, table: str) -> DataFrame:
    """(hour_key, begins, expires, sketch, last_write, n_rows) of a uniques table, its writers merged."""
    return state.merged_sessions(state.session_rows(spark, table))


def read_hourly_uniques(spark: SparkSession, table: str, as_of=None, expired: bool = False) -> DataFrame:
    """(hour_key, uv_est, last_write) of the hours that have not expired at `as_of` (default now), or of all hours."""
    sessions = read_sessions(spark, table)
    if expired:
        return U.sketch_estimates(U.merge_sketches(sessions, "hour_key"))
    now = as_of if as_of is not None else F.current_timestamp()
    return U.sketch_estimates(sessions.where((F.col("begins") <= now) & (F.col("expires") > now)))


def read_daily_uniques(spark: SparkSession, table: str) -> DataFrame:
    """(day, uv_est) by merging the hour sketches of a uniques table, expired ones too."""
    days = U.merge_sketches(read_sessions(spark, table), U.daily_key(), "day")
    return days.select("day", F.hll_sketch_estimate("sketch").alias("uv_est"))


def hourly_uniques_windowed(messages: DataFrame, watermark: str = "1 day",
                            lg_k: int = U.HLL_LG_K) -> DataFrame:
    """Event-time alternative: tumbling 1-hour windows over the message timestamp
    with a watermark. In append mode each hour is emitted once, after the
    watermark passes its end, and its state is then dropped, so state stays
    bounded by the watermark. Rows later than the watermark are dropped by Spark."""
    uh = messages.select("timestamp", csv_field("value", 0).alias("user_id"))
    return (uh.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", "1 hour").alias("w"))
            .agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"),
                 F.max("timestamp").alias("last_write"),
                 F.count(F.lit(1)).alias("n_rows"))
            .select(F.date_format("w.start", HOUR_KEY_PATTERN).alias("hour_key"),
                    "sketch", "last_write", "n_rows"))


def stop_gracefully(query: StreamingQuery, timeout_s: float = 60.0, poll_s: float = 0.2) -> None:
    """Stop after the running micro-batch finishes (or after `timeout_s`).
    An abrupt stop is safe too: the unfinished batch replays from the checkpoint."""
    deadline = time.monotonic() + timeout_s
    while query.isActive and query.status.get("isTriggerActive") and time.monotonic() < deadline:
        time.sleep(poll_s)
    query.stop()


def run_until_stopped(query: StreamingQuery, stop_file: str | None = None, poll_s: float = 1.0,
                      timeout_s: float = 60.0) -> str:
    """Wait for a query; stop it after its running batch when `stop_file` appears in the shared folder, or on SIGTERM
    or Ctrl-C. Returns what ended it: 'query', 'file' or 'signal'."""
    told = threading.Event()
    in_main = threading.current_thread() is threading.main_thread()
    before = signal.signal(signal.SIGTERM, lambda *_: told.set()) if in_main else None
    try:
        while not query.awaitTermination(poll_s):
            marked = stop_file is not None and state.exists(SparkSession.active(), stop_file)
            if told.is_set() or marked:
                stop_gracefully(query, timeout_s)
                return "file" if marked else "signal"
        return "query"
    except KeyboardInterrupt:
        stop_gracefully(query, timeout_s)
        return "signal"
    finally:
        if in_main:
            signal.signal(signal.SIGTERM, before)


def archive_stream(messages: DataFrame, path: str, checkpoint: str, minute_as_dir: bool = False,
                   trigger: str | None = ARCHIVE_TRIGGER, query_name: str | None = None,
                   processing_time: bool = False) -> StreamingQuery:
    """Raw lines into per-minute folders, CRLF line ends, one commit per trigger.

    Folders follow the message timestamp (a replay lands in the same folders);
    `processing_time=True` uses the batch's wall clock, as the reference's
    archiver does when it rolls its file every 60 s."""
    parts = list(A.MINUTE_DIR_COLUMNS if minute_as_dir else A.MINUTE_COLUMNS)
    stamped = messages.withColumn("_archive_ts", F.current_timestamp() if processing_time else F.col("timestamp"))
    rows = A.archive_columns(stamped, "_archive_ts", minute_as_dir).select("value", *parts)
    return _start(rows, "append", checkpoint, trigger, query_name,
                  lambda w: w.format("text").partitionBy(*parts).option("lineSep", A.LINE_SEP).option("path", path))


def archive_load_stream(spark: SparkSession, archive: str, table: str, checkpoint: str, minute_as_dir: bool = False,
                        trigger: str | None = "availableNow", query_name: str | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Parse the archive's files that are new since the last load into the `dt`-partitioned Parquet table.

    The checkpoint is the only bookkeeping: a file is read once, so loading an unchanged archive reads no line and the
    late lines of a loaded day are added without reading that day again."""
    parsed = A.parse_archived(A.stream_archive(spark, archive, minute_as_dir, max_files_per_trigger), minute_as_dir)
    return _start(parsed, "append", checkpoint, trigger, query_name,
                  lambda w: w.format("parquet").partitionBy("dt").option("path", table))
