"""Message sources: Kafka-shaped envelopes, text files and Kafka options.

A Kafka record reaches a Spark query as
``(key, value, topic, partition, offset, timestamp, timestampType)``.
`as_messages` builds that envelope from a table of lines (our stand-in for a
topic, used by tests, the bench and the file-source streams); `kafka_options`
builds the options for the real connector. The connector jar is not shipped
with this PySpark, so `read_kafka` is exercised only through its options.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions.dates import ntz_to_ms


def as_messages(lines: DataFrame, topic: str, partitions: int = 3, id_col: str = "event_id",
                ts_col: str = "ts", key: Column | None = None, offset: Column | None = None) -> DataFrame:
    """Envelope (topic, partition, offset, timestamp, key, value) of a line table: a projection.

    partition = id mod `partitions`; `offset` defaults to id div `partitions`,
    which numbers dense ids densely and leaves gaps where ids have gaps, as a compacted topic does; timestamp = the NTZ wall clock read as UTC.
    A row with a null id keeps its line, with null partition and offset.
    """
    ident = F.col(id_col).cast("bigint")
    return lines.select(
        F.lit(topic).alias("topic"),
        F.pmod(ident, F.lit(partitions)).cast("int").alias("partition"),
        (offset if offset is not None else F.floor(ident / F.lit(partitions))).cast("bigint").alias("offset"),
        F.timestamp_millis(ntz_to_ms(ts_col)).alias("timestamp"),
        (key if key is not None else F.lit(None).cast("string")).alias("key"),
        F.col("value").cast("string").alias("value"))


def read_text_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Batch text scan, one row per line (`value`)."""
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def stream_text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text scan of a folder; `max_files_per_trigger` is the file rate limit."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def stream_messages(spark: SparkSession, path: str, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming envelope rows from files (the stand-in for a topic)."""
    from logtide.schemas import ENVELOPE_SCHEMA
    reader = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_options(bootstrap: str, topics: list[str] | None = None,
                  assign: dict[str, list[int]] | None = None,
                  starting_offsets: dict[str, dict[str, int]] | str = "earliest",
                  max_rate_per_partition: int | None = None, batch_seconds: float | None = None,
                  partitions: int | None = None, group_id: str | None = None,
                  fail_on_data_loss: bool = True, extra: dict | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    * `topics` -> subscribe; `assign` -> explicit partitions.
    * `starting_offsets`: "earliest"/"latest" or ``{topic: {partition: offset}}``
      (e.g. the output of `start_offsets_json`).
    * A per-partition rate (messages/s) becomes ``maxOffsetsPerTrigger``, which is
      a total over all partitions per trigger: rate x interval x partitions. A rate that holds
      for each partition needs bounded runs: read the batch source (`spark.read.format("kafka")`)
      with both texts of `offsets.ranges_json` as `starting_offsets` and `extra={"endingOffsets": ...}`.
    * Offsets are tracked in the query checkpoint, so no auto-commit; `group_id`
      only names the consumer group (``kafka.group.id``), e.g. for broker ACLs.
    * Offsets that have aged out of the topic fail the query; `fail_on_data_loss=False`
      skips over them.
    """
    if (topics is None) == (assign is None):
        raise ValueError("give exactly one of topics / assign")
    opts = {"kafka.bootstrap.servers": bootstrap, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if topics is not None:
        opts["subscribe"] = ",".join(topics)
    else:
        opts["assign"] = json.dumps({t: sorted(p) for t, p in assign.items()})
    if isinstance(starting_offsets, dict):
        opts["startingOffsets"] = json.dumps(
            {t: {str(p): int(o) for p, o in parts.items()} for t, parts in starting_offsets.items()})
    else:
        opts["startingOffsets"] = starting_offsets
    if max_rate_per_partition is not None:
        if batch_seconds is None or partitions is None:
            raise ValueError("a per-partition rate needs batch_seconds and partitions")
        opts["maxOffsetsPerTrigger"] = str(int(max_rate_per_partition * batch_seconds * partitions))
    if group_id is not None:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming Kafka source cast to the text envelope. Needs the Kafka connector jar."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("topic", "partition", "offset", "timestamp",
                      F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
