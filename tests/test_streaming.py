"""Streaming = batch; restart processes nothing; a replayed batch leaves totals unchanged."""

import datetime as dt
import glob
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from conftest import SF0001 as SF0001_DIR
from logtide.operators import counters as C
from logtide.operators import uniques as U
from logtide.operators import archive as A
from logtide.sources.messages import as_messages, stream_messages, stream_text_lines
from logtide.sources.tables import csv_lines, load_table, startup_lines
from logtide.operators import offsets as O
from logtide.streaming import jobs, ledger, state


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _write_source(spark, msgs, path, files=4):
    msgs.repartitionByRange(files, "timestamp").write.parquet(path)
    return path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _uncommit(checkpoint, batch):
    """As if the job had died before batch `batch` committed: its commit marker and that file's checksum are gone."""
    for name in (str(batch), f".{batch}.crc"):
        marker = os.path.join(_local(checkpoint), "commits", name)
        if os.path.exists(marker):
            os.remove(marker)


def _batches(checkpoint):
    return sorted(int(n) for n in os.listdir(os.path.join(_local(checkpoint), "commits")) if n.isdigit())


def test_click_counter_stream(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"))
    table = scratch("clicks")
    assert _rows(jobs.read_click_counter(spark, table)) == []
    changed = []

    def run():
        stream = stream_messages(spark, src, max_files_per_trigger=1)
        jobs.click_counter_stream(spark, stream, table, trigger="availableNow", repartition=3, on_change=lambda rows, n: changed.append(
            (n, rows.rdd.getNumPartitions(), {r.row_key: r.click_count for r in rows.collect()}))).awaitTermination()

    run()
    want = _rows(C.city_click_counts(msgs.select("value")))
    checkpoint = state.checkpoint_of(table, "main")
    assert _rows(jobs.read_click_counter(spark, table)) == want
    assert [n for n, _, _ in changed] == _batches(checkpoint) == [0, 1, 2, 3] and {p for _, p, _ in changed} == {3}
    put = {}
    for _, _, totals in changed:
        put.update(totals)                               # what a store that only puts would hold
    assert sorted(put.items()) == want

    run()                                                # restart on the same checkpoint: nothing new
    assert _batches(checkpoint) == [0, 1, 2, 3] and len(changed) == 4

    _uncommit(checkpoint, 3)                             # the last batch runs again, from the state before it
    run()
    assert changed[4] == changed[3]
    assert _rows(jobs.read_click_counter(spark, table)) == want
    assert sorted(os.listdir(_local(table))) == ["main"] and sorted(os.listdir(_local(table) + "/main")) == ["checkpoint"]


def test_counter_state_is_rocksdb_with_changelogs(spark, scratch):
    src = _write_source(spark, as_messages(startup_lines(load_table(spark, SF0001_DIR, "events")), "app-log", 3), scratch("src"), 2)
    table = scratch("clicks")
    jobs.click_counter_stream(spark, stream_messages(spark, src), table, trigger="availableNow").awaitTermination()
    entry = open(_local(state.checkpoint_of(table, "main")) + "/offsets/0").read().splitlines()
    assert "RocksDBStateStoreProvider" in json.loads(entry[1])["conf"]["spark.sql.streaming.stateStore.providerClass"]
    assert glob.glob(_local(table) + "/main/checkpoint/state/0/*/*.changelog")


def test_two_writers_of_one_counter(spark, scratch):
    """Two checkpoints on one table: each message counts once per writer, whatever is replayed or restarted."""
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    halves = [msgs.where(F.col("partition") == 0), msgs.where(F.col("partition") != 0)]
    srcs = [_write_source(spark, h, scratch("src"), files=2) for h in halves]
    table = scratch("clicks")
    for _ in range(2):
        for w, src in enumerate(srcs):
            jobs.click_counter_stream(spark, stream_messages(spark, src, max_files_per_trigger=1), table, f"w{w}",
                                      trigger="availableNow").awaitTermination()
            _uncommit(state.checkpoint_of(table, f"w{w}"), 1)          # each last batch is replayed in the second round
    assert state.writers(spark, table) == ["w0", "w1"]
    for w, src in enumerate(srcs):
        jobs.click_counter_stream(spark, stream_messages(spark, src), table, f"w{w}", trigger="availableNow").awaitTermination()
    assert _rows(jobs.read_click_counter(spark, table)) == _rows(C.city_click_counts(msgs.select("value")))


def test_hourly_uniques_stream(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(csv_lines(ev), "user-csv", 3)
    src = _write_source(spark, msgs, scratch("src"), files=3)
    table = scratch("uv")
    jobs.hourly_uniques_stream(spark, stream_messages(spark, src, max_files_per_trigger=1), table,
                               trigger="availableNow", watermark="60 days").awaitTermination()
    est = jobs.read_hourly_uniques(spark, table, expired=True)
    exact = U.user_hours(msgs).groupBy("hour_key").agg(F.count_distinct("user_id").alias("uv"))
    j = est.join(exact, "hour_key")
    assert j.count() == exact.count() and j.where(~U.within_bound(F.col("uv_est"), F.col("uv"))).count() == 0
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    want = U.retained(U.hourly_sketches(U.user_hours(msgs)), as_of)
    kept = {r.hour_key for r in jobs.read_hourly_uniques(spark, table, as_of=as_of).collect()}
    begun = {r.hour_key for r in want.collect() if r.hour_key < "20240130-12"}       # the others begin after `as_of`
    assert kept == begun and 0 < len(kept) < exact.count()
    assert jobs.read_daily_uniques(spark, table).count() == 30
    assert jobs.read_hourly_uniques(spark, scratch("none")).count() == 0


def test_archive_stream(spark, scratch):
    # whole sf0.001 table: at sf0.01 nearly every line gets its own minute folder
    ev = load_table(spark, SF0001_DIR, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"), files=2)
    out, ckpt = scratch("archive"), scratch("ckpt")
    jobs.archive_stream(stream_messages(spark, src, max_files_per_trigger=1), out, ckpt,
                        trigger="availableNow").awaitTermination()
    back = spark.read.text(out)
    assert sorted(r.value for r in back.select("value").collect()) == sorted(r.value for r in msgs.select("value").collect())
    f = glob.glob(_local(out) + "/ym=*/dd=*/hhmm=*/*.txt")[0]
    assert open(f, "rb").read().endswith(b"\r\n")


def test_stateful_alternative_equals_batch(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"), files=3)
    counts = jobs.click_counter_stateful(stream_messages(spark, src, max_files_per_trigger=1))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("stateful_clicks")
         .option("checkpointLocation", scratch("ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert _rows(spark.table("stateful_clicks")) == _rows(C.city_click_counts(msgs.select("value")))


def test_windowed_uniques_equal_batch(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(csv_lines(ev), "user-csv", 3)
    src = _write_source(spark, msgs, scratch("src"), files=3)
    win = jobs.hourly_uniques_windowed(stream_messages(spark, src, max_files_per_trigger=1), watermark="365 days")
    q = (win.select("hour_key", F.hll_sketch_estimate("sketch").alias("uv_est"), "n_rows")
         .writeStream.outputMode("complete").format("memory").queryName("win_uv")
         .option("checkpointLocation", scratch("ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("win_uv")
    exact = U.user_hours(msgs).groupBy("hour_key").agg(F.count_distinct("user_id").alias("uv"),
                                                       F.count(F.lit(1)).alias("n"))
    j = got.join(exact, "hour_key")
    assert j.count() == exact.count() == got.count()
    assert j.where((F.col("n") != F.col("n_rows")) | ~U.within_bound(F.col("uv_est"), F.col("uv"))).count() == 0


def test_stop_gracefully(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"), files=2)
    q = jobs.click_counter_stream(spark, stream_messages(spark, src, max_files_per_trigger=1), scratch("t"), trigger="1 second")
    q.processAllAvailable()
    jobs.stop_gracefully(q, timeout_s=30)
    assert not q.isActive


def test_text_stream_click_counter(spark, scratch):
    """Raw JSON lines in text files (no envelope) through the click counter."""
    ev = load_table(spark, SF001, "events")
    lines = startup_lines(ev).select("value")
    src = scratch("text-src")
    lines.repartition(3).write.text(src)
    table = scratch("clicks")
    jobs.click_counter_stream(spark, stream_text_lines(spark, src, max_files_per_trigger=1), table,
                              trigger="availableNow").awaitTermination()
    assert _rows(jobs.read_click_counter(spark, table)) == _rows(C.city_click_counts(lines))


def test_load_streamed_archive(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs.where(F.col("timestamp") < F.lit("2024-01-03").cast("timestamp")),
                        scratch("src"), files=2)
    out = scratch("archive")
    jobs.archive_stream(stream_messages(spark, src, max_files_per_trigger=1), out, scratch("ckpt"),
                        trigger="availableNow").awaitTermination()
    table = A.load_archive(spark, out, scratch("table"))
    got = {r.dt: r.n for r in table.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {r.dt: r.n for r in msgs.where(F.col("timestamp") < F.lit("2024-01-03").cast("timestamp"))
            .groupBy(F.date_format("timestamp", "yyyyMMdd").alias("dt")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_runner_on_files(spark, scratch):
    from logtide.streaming import run
    ev = load_table(spark, SF0001_DIR, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"), files=2)
    table = scratch("clicks")
    assert run.main(["clicks", "--files", src, "--max-files", "1", "--table", table, "--trigger", "availableNow"]) == "query"
    assert _rows(jobs.read_click_counter(spark, table)) == _rows(C.city_click_counts(msgs.select("value")))
    args = run.parse_args(["uniques", "--kafka", "h:9092", "--topic", "t", "--rate", "100", "--partitions", "3",
                           "--table", table])
    assert args.rate == 100 and run.kafka_source_options(spark, args)["maxOffsetsPerTrigger"] == "300"


def test_windowed_uniques_watermark_expires_state(spark, scratch):
    ev = load_table(spark, SF001, "events")
    msgs = as_messages(csv_lines(ev), "user-csv", 3)
    src = scratch("src")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for lo, hi in zip(cuts, cuts[1:]):          # time-ordered files, written one after another
        part = msgs.where((F.col("timestamp") >= F.lit(lo).cast("timestamp")) & (F.col("timestamp") < F.lit(hi).cast("timestamp")))
        part.coalesce(1).write.mode("append").parquet(src)
    win = jobs.hourly_uniques_windowed(stream_messages(spark, src, max_files_per_trigger=1), watermark="1 hour")
    q = (win.select("hour_key", F.hll_sketch_estimate("sketch").alias("uv_est"), "n_rows")
         .writeStream.outputMode("append").format("memory").queryName("win_uv_append")
         .option("checkpointLocation", scratch("ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("win_uv_append")
    exact = U.user_hours(msgs).groupBy("hour_key").agg(F.count_distinct("user_id").alias("uv"),
                                                       F.count(F.lit(1)).alias("n"))
    j = got.join(exact, "hour_key")
    assert j.count() == got.count() >= exact.count() - 3          # all but the newest hours emitted
    assert j.where((F.col("n") != F.col("n_rows")) | ~U.within_bound(F.col("uv_est"), F.col("uv"))).count() == 0
    state_rows = sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"])
    assert state_rows <= 3                                        # only windows newer than the watermark kept


def test_runner_archive_from_text(spark, scratch):
    from logtide.streaming import run
    ev = load_table(spark, SF0001_DIR, "events")
    lines = startup_lines(ev).select("value")
    src = scratch("text-src")
    lines.coalesce(1).write.text(src)
    out = scratch("archive")
    run.main(["archive", "--text", src, "--path", out, "--checkpoint", scratch("ckpt"), "--trigger", "availableNow"])
    back = spark.read.text(out)
    assert back.count() == lines.count()
    assert back.select("ym").distinct().count() <= 2          # processing-time month (two only at a boundary)


def test_runner_load(spark, scratch):
    from logtide.operators import archive as A
    from logtide.streaming import run
    ev = load_table(spark, SF0001_DIR, "events")
    msgs = as_messages(startup_lines(ev), "app-log", 3)
    path, table = scratch("archive"), scratch("table")
    A.write_archive(msgs, path)
    run.main(["load", "--path", path, "--table", table, "--day", "20240103", "--day", "20240104"])
    got = {str(r.dt) for r in spark.read.parquet(table).select("dt").distinct().collect()}
    assert got == {"20240103", "20240104"}


def _startup(city, ms=1704103200000):
    return '{"appVersion":"1","userId":"u","appId":"a","city":"%s","startTimeInMs":%d}' % (city, ms)


USER_EVENTS = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
DAY0 = dt.datetime(2024, 1, 1)


def _user_events(spark, src, rows):
    """Append one source file of (hours since the start, user)."""
    spark.createDataFrame([("t", 0, i, DAY0 + dt.timedelta(hours=h), None, f"{u},x") for i, (h, u) in enumerate(rows)], USER_EVENTS) \
        .coalesce(1).write.mode("append").parquet(src)


def _uniques(spark, src, table, writer="main", **kw):
    """Run the uniques job over what is there; returns the query."""
    q = jobs.hourly_uniques_stream(spark, stream_messages(spark, src), table, writer, trigger="availableNow",
                                   watermark="0 seconds", **kw)
    q.awaitTermination()
    return q


def _alive(spark, table, hours):
    as_of = F.lit(DAY0 + dt.timedelta(hours=hours)).cast("timestamp")
    return {r.hour_key: r.uv_est for r in jobs.read_hourly_uniques(spark, table, as_of=as_of).collect()}


@pytest.fixture
def one_hour_key(monkeypatch):
    """Every message belongs to one hour key: as with the reference's wall-clock keys and messages that come late."""
    from logtide.functions.dates import hour_key
    monkeypatch.setattr(U, "hour_key", lambda ts=None: F.when(ts.isNotNull(), hour_key(F.lit(DAY0).cast("timestamp"))))
    return "20240101-00"


def test_each_write_renews_the_key(spark, scratch, one_hour_key):
    """Written at 0, 20 and 40 h a key lives on with all its users until 64 h; then it leaves the state."""
    src, table = scratch("src"), scratch("uv")
    _user_events(spark, src, [(0, "a"), (0.5, "b")])
    _uniques(spark, src, table)
    _user_events(spark, src, [(20, "c")])
    _uniques(spark, src, table)
    _user_events(spark, src, [(40, "d"), (40, "a")])
    q = _uniques(spark, src, table)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    assert _alive(spark, table, 63.9) == {one_hour_key: 4} and _alive(spark, table, 64.1) == {}
    _user_events(spark, src, [(70, "e")])                                   # after it expired: a new life
    _uniques(spark, src, table)
    q = _uniques(spark, src, table)
    assert state.read_state(spark, state.checkpoint_of(table, "main")).count() == 1
    closed = spark.read.parquet(state.closed_of(table, "main")).collect()
    assert [(r.hour_key, r.n_rows, r.expires) for r in closed] == [(one_hour_key, 5, DAY0 + dt.timedelta(hours=64))]
    assert _alive(spark, table, 71) == {one_hour_key: 1}
    assert {r.hour_key: r.uv_est for r in jobs.read_hourly_uniques(spark, table, expired=True).collect()} == {one_hour_key: 5}


def test_unwritten_hours_leave_the_state(spark, scratch):
    src, table = scratch("src"), scratch("uv")
    _user_events(spark, src, [(0, "a"), (1, "b"), (2, "c")])
    _uniques(spark, src, table)
    _user_events(spark, src, [(25.5, "d")])
    _uniques(spark, src, table)
    left = {r.key.hour_key for r in state.read_state(spark, state.checkpoint_of(table, "main")).collect()}
    assert left == {"20240101-02", "20240102-01"}
    assert set(_alive(spark, table, 25.5)) == left
    assert jobs.read_hourly_uniques(spark, table, expired=True).count() == 4          # closed sessions stay readable


def test_two_writers_renew_one_key(spark, scratch, one_hour_key):
    """One writer's session ends while the other still writes the key: its users live on with the key."""
    srcs, table = [scratch("src"), scratch("src")], scratch("uv")
    _user_events(spark, srcs[0], [(0, "a"), (1, "b")])
    _uniques(spark, srcs[0], table, "w0")
    _user_events(spark, srcs[1], [(20, "c")])
    _uniques(spark, srcs[1], table, "w1")
    _user_events(spark, srcs[0], [(50, "z")])                    # w0 forgets a and b: they were last written at 1 h
    _uniques(spark, srcs[0], table, "w0")
    _uniques(spark, srcs[0], table, "w0")
    assert spark.read.parquet(state.closed_of(table, "w0")).count() == 1
    assert _alive(spark, table, 43.9)[one_hour_key] == 3
    sessions = sorted((r.begins, r.expires, r.n_rows) for r in jobs.read_sessions(spark, table).collect())
    hour = lambda h: DAY0 + dt.timedelta(hours=h)
    assert sessions == [(hour(0), hour(44), 3), (hour(50), hour(74), 1)]
    assert _alive(spark, table, 51) == {one_hour_key: 1}         # 50 h is after 44 h: only z


def test_repartition_and_processing_time_of_uniques(spark, scratch):
    src, table = scratch("src"), scratch("uv")
    _user_events(spark, src, [(h, f"u{h}") for h in range(30)])
    q = jobs.hourly_uniques_stream(spark, stream_messages(spark, src), table, processing_time=True, repartition=3,
                                   trigger="availableNow")
    q.awaitTermination()
    rows = jobs.read_hourly_uniques(spark, table).collect()
    assert 1 <= len(rows) <= 2 and sum(r.uv_est for r in rows) == 30


def test_archive_stream_restart_replay_and_day_load(spark, scratch):
    """Two runs append to the same minute; a replay and an orphan file add no rows, by root or by day."""
    src, out, ckpt = scratch("src"), scratch("archive"), scratch("ckpt")
    schema = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
    from datetime import datetime
    at = datetime(2024, 1, 5, 10, 20, 5)

    def run():
        jobs.archive_stream(stream_messages(spark, src), out, ckpt, trigger="availableNow").awaitTermination()

    for n in range(2):
        spark.createDataFrame([("t", 0, n, at, None, "line %d\nwith a break" % n)], schema).write.mode("append").parquet(src)
        run()
    minute = glob.glob(_local(out) + "/ym=202401/dd=05/hhmm=1020")[0]
    for name in ("1", ".1.crc"):
        marker = os.path.join(_local(ckpt), "commits", name)
        if os.path.exists(marker):
            os.remove(marker)
    run()
    with open(os.path.join(minute, "part-orphan.txt"), "wb") as f:
        f.write(b"never committed\r\n")
    want = ["line 0\nwith a break", "line 1\nwith a break"]
    assert sorted(r.value for r in A.read_archive(spark, out).collect()) == want
    assert sorted(r.value for r in A.read_archive(spark, out, day=["20240105", "20240107"]).collect()) == want
    assert A.read_archive(spark, out, day="20240106").count() == 0
    with pytest.raises(ValueError):
        A.write_archive(spark.createDataFrame([("x", at)], "value string, timestamp timestamp"), out)


def _topic_source(spark):
    """A streaming source with offsets per partition, as Kafka's: a JSON file says how far each partition reaches."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Part(InputPartition):
        def __init__(self, partition, a, b):
            self.partition, self.a, self.b = partition, a, b

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.path = options["ends"]

        def _ends(self):
            with open(self.path) as f:
                return json.load(f)

        def initialOffset(self):
            return {"t": {p: 0 for p in self._ends()}}

        def latestOffset(self):
            return {"t": self._ends()}

        def partitions(self, start, end):
            return [Part(int(p), start["t"].get(p, 0), end["t"][p]) for p in end["t"]]

        def read(self, partition):
            for o in range(partition.a, partition.b):
                yield ('{"appVersion":"1","userId":"u","appId":"a","city":"c%d","startTimeInMs":1704103200000}' % partition.partition,)

    class Topic(DataSource):
        @classmethod
        def name(cls):
            return "test_topic"

        def schema(self):
            return "value string"

        def streamReader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(Topic)


def _ledger_rows(rows):
    return sorted((r.batch_id, r.topic, r.partition, r.from_offset, r.until_offset) for r in rows.collect())


def test_ledger_records_committed_offsets(spark, scratch, tmp_path):
    """Progress after commit becomes ledger rows; after a lost driver and a restart the ledger equals the checkpoint."""
    _topic_source(spark)
    ends, table, folder = str(tmp_path / "ends.json"), scratch("clicks"), scratch("ledger")
    checkpoint = state.checkpoint_of(table, "main")

    def run(reach, listen=True):
        with open(ends, "w") as f:
            json.dump(reach, f)
        listener = ledger.OffsetLedger(spark, folder)
        if listen:
            spark.streams.addListener(listener)
        messages = spark.readStream.format("test_topic").option("ends", ends).load()
        q = jobs.click_counter_stream(spark, messages, table, trigger="once")
        q.awaitTermination()
        if listen:
            deadline = time.monotonic() + 30
            while not ledger.read_ledger(spark, folder).where(F.col("batch_id") == max(_batches(checkpoint))).count() \
                    and time.monotonic() < deadline:
                time.sleep(0.2)
                listener.flush()
            spark.streams.removeListener(listener)

    run({"0": 5, "1": 3})
    run({"0": 9, "1": 3, "2": 4})
    first = [(0, "t", 0, None, 5), (0, "t", 1, None, 3)]
    second = [(1, "t", 0, 5, 9), (1, "t", 2, None, 4)]
    assert _ledger_rows(ledger.read_ledger(spark, folder)) == first + second
    assert ledger.catch_up(spark, checkpoint, folder) == 0
    run({"0": 10, "1": 3, "2": 4}, listen=False)                          # this batch's report is lost
    assert ledger.catch_up(spark, checkpoint, folder) == 1 and ledger.catch_up(spark, checkpoint, folder) == 0
    rows = ledger.read_ledger(spark, folder)
    assert _ledger_rows(rows) == _ledger_rows(ledger.checkpoint_ledger(spark, checkpoint)) == first + second + [(2, "t", 0, 9, 10)]
    ranges = {(r.batch_id, r.partition): (r.from_offset, r.until_offset) for r in O.ledger_ranges(rows).collect()}
    assert ranges[2, 0] == (9, 10) and len(ranges) == 5
    parts = spark.createDataFrame([("t", p) for p in range(3)], "topic string, partition int")
    assert ledger.ledger_start_offsets(spark, folder, parts) == {"t": {"0": 10, "1": 3, "2": 4}}
    more = parts.union(spark.createDataFrame([("t", 3)], parts.schema))
    assert set(ledger.ledger_start_offsets(spark, folder, more)["t"].values()) == {0}
    assert _rows(jobs.read_click_counter(spark, table)) == [("2024-01-01_c0", 10), ("2024-01-01_c1", 3), ("2024-01-01_c2", 4)]


def test_uncommitted_batches_are_not_in_the_ledger(spark, scratch):
    src = _write_source(spark, as_messages(startup_lines(load_table(spark, SF0001_DIR, "events")), "app-log", 3), scratch("src"), 3)
    table, folder = scratch("clicks"), scratch("ledger")
    jobs.click_counter_stream(spark, stream_messages(spark, src, max_files_per_trigger=1), table, trigger="availableNow").awaitTermination()
    checkpoint = state.checkpoint_of(table, "main")
    _uncommit(checkpoint, 2)
    assert ledger.catch_up(spark, checkpoint, folder) == 2
    assert _ledger_rows(ledger.read_ledger(spark, folder)) == [(0, "logOffset", 0, None, 1), (1, "logOffset", 0, 1, 2)]
    assert ledger.read_ledger(spark, scratch("none")).count() == 0
    assert ledger.checkpoint_ledger(spark, scratch("none")).count() == 0


def test_launcher_keeps_a_ledger_and_stops_on_a_file(spark, scratch):
    """A marker ends a running launcher after its batch; a restart replays nothing."""
    from logtide.streaming import run
    msgs = as_messages(startup_lines(load_table(spark, SF0001_DIR, "events")), "app-log", 3)
    src = _write_source(spark, msgs, scratch("src"), files=2)
    table, folder, marker = scratch("clicks"), scratch("ledger"), scratch("stop")
    args = ["clicks", "--files", src, "--max-files", "1", "--table", table, "--writer", "w", "--ledger", folder]
    ended = []
    job = threading.Thread(target=lambda: ended.append(run.main(args + ["--trigger", "1 second", "--stop-file", marker])))
    job.start()
    checkpoint, deadline = state.checkpoint_of(table, "w"), time.monotonic() + 60
    while time.monotonic() < deadline and not (os.path.isdir(_local(checkpoint) + "/commits") and len(_batches(checkpoint)) == 2):
        time.sleep(0.3)
    assert job.is_alive()
    os.makedirs(os.path.dirname(_local(marker)), exist_ok=True)
    open(_local(marker), "w").close()
    job.join(60)
    assert ended == ["file"] and _batches(checkpoint) == [0, 1]
    assert [r[0] for r in _ledger_rows(ledger.read_ledger(spark, folder))] == [0, 1]
    assert run.main(args + ["--trigger", "availableNow"]) == "query" and _batches(checkpoint) == [0, 1]
    assert _rows(jobs.read_click_counter(spark, table)) == _rows(C.city_click_counts(msgs.select("value")))


def test_incremental_archive_load(spark, scratch):
    """A load reads only files that no load has read: none of an unchanged archive, late lines once."""
    src, out, table, ckpt = scratch("src"), scratch("archive"), scratch("table"), scratch("ckpt")
    at = dt.datetime(2024, 1, 5, 10, 20, 5)

    def archived(lines, when, streamed):
        rows = spark.createDataFrame([("t", 0, n, when, None, line) for n, line in enumerate(lines)], USER_EVENTS)
        if streamed:
            rows.write.mode("append").parquet(src)
            jobs.archive_stream(stream_messages(spark, src), out + "-s", ckpt + "-a", trigger="availableNow").awaitTermination()
        else:
            A.write_archive(rows, out)

    def load(streamed):
        q = jobs.archive_load_stream(spark, out + ("-s" if streamed else ""), table + str(streamed), ckpt + str(streamed))
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    for streamed in (False, True):
        archived([_startup("a"), _startup("b"), "junk"], at, streamed)
        archived([_startup("c")], at + dt.timedelta(days=1), streamed)
        assert load(streamed) == 4
        assert load(streamed) == 0
        archived([_startup("late")], at, streamed)                        # a line of a loaded day and minute
        assert load(streamed) == 1 and load(streamed) == 0
        got = sorted(((str(r.dt), r.city) for r in spark.read.parquet(table + str(streamed)).collect()), key=str)
        assert got == [("20240105", "a"), ("20240105", "b"), ("20240105", "late"), ("20240105", None), ("20240106", "c")]


def test_kafka_launcher_options(spark, scratch):
    from logtide.streaming import run
    folder = scratch("ledger")

    def options(*more):
        return run.kafka_source_options(spark, run.parse_args(
            ["clicks", "--kafka", "h:9092", "--table", "t", "--ledger", folder, *more]))

    first = options("--topic", "t", "--topic-partitions", "t:2", "--resume-from-ledger")     # nothing written yet
    assert first["startingOffsets"] == '{"t": {"0": 0, "1": 0}}' and first["failOnDataLoss"] == "true"
    spark.createDataFrame([("q", 0, 0, "t", 0, None, 5), ("q", 0, 0, "t", 1, 2, 9)], ledger.LEDGER_SCHEMA).write.parquet(folder)
    assert options("--assign", "t:0,1", "--resume-from-ledger")["startingOffsets"] == '{"t": {"0": 5, "1": 9}}'
    assert options("--topic", "t", "--topic-partitions", "t:3", "--resume-from-ledger")["startingOffsets"] == \
        '{"t": {"0": 0, "1": 0, "2": 0}}'
    assert options("--assign", "t:1,0")["assign"] == '{"t": [0, 1]}'
    assert options("--topic", "t", "--rate", "100", "--partitions", "3")["maxOffsetsPerTrigger"] == "1500"
    assert options("--assign", "t:0,1", "--rate", "100", "--trigger", "10 seconds")["maxOffsetsPerTrigger"] == "2000"
    assert options("--topic", "t", "--fail-on-data-loss", "false")["failOnDataLoss"] == "false"
    for bad in ([], ["--topic", "t", "--assign", "t:0"], ["--topic", "t", "--resume-from-ledger"],
                ["--topic", "t", "--rate", "1", "--partitions", "1", "--trigger", "availableNow"]):
        with pytest.raises(SystemExit):
            options(*bad)
