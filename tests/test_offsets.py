"""Offsets: envelopes, ranges, start offsets, Kafka options."""

import json

import pytest
from pyspark.sql import functions as F

from logtide.operators import offsets as O
from logtide.sources.messages import as_messages, kafka_options


def test_envelope_keeps_rows_without_an_id(spark):
    lines = spark.createDataFrame([(0, "a"), (4, "b"), (None, "c")], "event_id long, value string") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = sorted(((r.partition, r.offset, r.value) for r in as_messages(lines, "t", 3).collect()), key=str)
    assert got == [(0, 0, "a"), (1, 1, "b"), (None, None, "c")]
    sparse = spark.createDataFrame([(0, "a"), (30, "b"), (33, "c")], "event_id long, value string") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert sorted(r.offset for r in as_messages(sparse, "t", 3).collect()) == [0, 10, 11]      # gaps stay gaps


def test_committed_offsets_in_one_pass(spark):
    msgs = _msgs(spark, [("t", p, o) for p in range(3) for o in range(4)] + [("s", 0, 7)])
    done = O.committed_of(msgs, (F.col("partition") != 2) & (F.col("offset") < 2) | (F.col("topic") == "s"))
    assert O.start_offsets_json(done).first()[0] == '{"s":{"0":0},"t":{"0":0,"1":0,"2":0}}'
    assert O.start_offsets_json(done, all_or_nothing=False).first()[0] == '{"s":{"0":8},"t":{"0":2,"1":2,"2":0}}'
    full = O.committed_of(msgs, F.col("offset") >= 0)
    assert O.start_offsets_json(full).first()[0] == '{"s":{"0":8},"t":{"0":4,"1":4,"2":4}}'


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long")


def test_ranges_and_start_offsets(spark):
    msgs = _msgs(spark, [("t", 0, o) for o in range(5)] + [("t", 1, o) for o in range(3)] + [("t", 2, 0)])
    ranges = {(r.partition, r.from_offset, r.until_offset) for r in O.offset_ranges(msgs).collect()}
    assert ranges == {(0, 0, 5), (1, 0, 3), (2, 0, 1)}
    parts = _msgs(spark, [("t", p, 0) for p in range(3)])
    ledger = spark.createDataFrame([("t", 0, 0, 5)], "topic string, partition int, from_offset long, until_offset long")
    # a partition missing from the ledger makes the lookup fail: all start at 0
    js = O.start_offsets_json(O.start_offsets(parts, ledger)).first().starting_offsets
    assert json.loads(js) == {"t": {"0": 0, "1": 0, "2": 0}}
    # per-partition defaults on request
    js = O.start_offsets_json(O.start_offsets(parts, ledger, all_or_nothing=False)).first().starting_offsets
    assert json.loads(js) == {"t": {"0": 5, "1": 0, "2": 0}}
    full = ledger.unionByName(spark.createDataFrame(
        [("t", 1, 0, 2), ("t", 2, 0, 7), ("t", 0, 5, 9)], ledger.schema))
    js = O.start_offsets_json(O.start_offsets(parts, full)).first().starting_offsets
    assert js == '{"t":{"0":9,"1":2,"2":7}}'
    empty = spark.createDataFrame([], ledger.schema)
    js = O.start_offsets_json(O.start_offsets(parts, empty)).first().starting_offsets
    assert json.loads(js) == {"t": {"0": 0, "1": 0, "2": 0}}


def test_kafka_options():
    o = kafka_options("b:9092", topics=["app-log"], starting_offsets={"app-log": {0: 5, 1: 0}},
                      max_rate_per_partition=100, batch_seconds=5, partitions=3)
    assert o["subscribe"] == "app-log"
    assert json.loads(o["startingOffsets"]) == {"app-log": {"0": 5, "1": 0}}
    assert o["maxOffsetsPerTrigger"] == "1500" and o["failOnDataLoss"] == "true"
    assert kafka_options("b", topics=["t"], fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert kafka_options("b:9092", topics=["t"], group_id="g1")["kafka.group.id"] == "g1"
    bounded = kafka_options("b:9092", topics=["t"], starting_offsets='{"t":{"0":5}}', extra={"endingOffsets": '{"t":{"0":9}}'})
    assert bounded["startingOffsets"] == '{"t":{"0":5}}' and bounded["endingOffsets"] == '{"t":{"0":9}}'
    a = kafka_options("b:9092", assign={"t": [1, 0]})
    assert json.loads(a["assign"]) == {"t": [0, 1]} and a["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_options("b", topics=["t"], max_rate_per_partition=1)


def test_kafka_source_needs_connector(spark):
    from logtide.sources.messages import read_kafka
    with pytest.raises(Exception):
        read_kafka(spark, kafka_options("localhost:1", topics=["t"]))


def test_admission_holds_per_partition(spark):
    """A hot partition never takes more than its own rate, and runs from the ledger read everything once."""
    ends = {0: 100_000, 1: 700, 2: 0, 3: 1500}
    available = spark.createDataFrame([("t", p, e) for p, e in ends.items()], "topic string, partition int, end_offset long")
    ledger, read, runs = [("t", p, 0, 0) for p in ends], {p: 0 for p in ends}, 0
    while True:
        rows = spark.createDataFrame(ledger, "topic string, partition int, from_offset long, until_offset long")
        ranges = O.admitted_ranges(available, rows, rate=2000, seconds=10).collect()
        for r in ranges:
            assert r.from_offset == read[r.partition] and 0 <= r.until_offset - r.from_offset <= 20_000
            read[r.partition] = r.until_offset
        ledger += [(r.topic, r.partition, r.from_offset, r.until_offset) for r in ranges]
        runs += 1
        if all(r.from_offset == r.until_offset for r in ranges):
            break
    assert read == ends and runs == 6
    # partitions without a committed offset: all start at 0, or only those
    part = spark.createDataFrame([("t", 0, 0, 50)], "topic string, partition int, from_offset long, until_offset long")
    assert {r.partition: r.from_offset for r in O.admitted_ranges(available, part, 1, 1).collect()} == dict.fromkeys(ends, 0)
    lone = O.admitted_ranges(available, part, 1, 10, all_or_nothing=False)
    assert {r.partition: (r.from_offset, r.until_offset) for r in lone.collect()} == {0: (50, 60), 1: (0, 10), 2: (0, 0), 3: (0, 10)}
    texts = O.ranges_json(lone).first()
    assert json.loads(texts.starting_offsets) == {"t": {"0": 50, "1": 0, "2": 0, "3": 0}}
    assert json.loads(texts.ending_offsets) == {"t": {"0": 60, "1": 10, "2": 0, "3": 10}}
