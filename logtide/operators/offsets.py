"""Offset bookkeeping of a partitioned log: batch ranges, committed and start offsets.

* `offset_ranges`  per (batch, topic, partition): from_offset = first offset,
                   until_offset = last offset + 1 (what a batch commits).
* `committed`      per (topic, partition): the highest committed until_offset.
* `start_offsets`  offset to resume each partition from. As in the reference's
                   offset lookup, the answer is all-or-nothing: if any requested
                   partition has no committed offset, the lookup counts as
                   failed and every partition starts from 0.
* `start_offsets_json` the ``{"topic":{"0":n,...}}`` text Spark's Kafka source
                   takes as ``startingOffsets``.
* `committed_of`   the same committed offsets straight from a message table.
* `ledger_ranges`  the offset ranges per batch that a stream's ledger recorded.
* `admitted_ranges`, `ranges_json`  per-partition admission for bounded runs: from the
                   committed offset on, at most rate x seconds messages of each
                   partition, so a hot partition takes no other's share.

The committed table holds one row per topic-partition, a count fixed by the
topic configuration, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_ranges(messages: DataFrame, batch_col: str | None = None) -> DataFrame:
    """(batch?, topic, partition, from_offset, until_offset) of a message table."""
    keys = ([batch_col] if batch_col else []) + ["topic", "partition"]
    return messages.groupBy(*keys).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"))


def committed(ledger: DataFrame) -> DataFrame:
    """(topic, partition, committed_offset): highest committed until_offset."""
    return ledger.groupBy("topic", "partition").agg(F.max("until_offset").alias("committed_offset"))


def committed_of(messages: DataFrame, done) -> DataFrame:
    """(topic, partition, committed_offset): after the last message where `done` holds, null where none does."""
    return messages.groupBy("topic", "partition").agg(
        F.max(F.when(done, F.col("offset") + 1)).alias("committed_offset"))


def start_offsets(partitions: DataFrame, ledger: DataFrame, all_or_nothing: bool = True) -> DataFrame:
    """(topic, partition, start_offset) for every row of `partitions`.

    `all_or_nothing=True` is the reference's lookup: it fails as a whole when
    any partition lacks a committed offset, and then every partition starts at
    0. `False` defaults only the missing partitions to 0.
    """
    parts = partitions.select("topic", "partition").distinct()
    joined = parts.join(committed(ledger), ["topic", "partition"], "left")
    zero = F.lit(0).cast("bigint")
    if all_or_nothing:
        missing = joined.select(F.count_if(F.col("committed_offset").isNull())).scalar()
        start = F.when(missing > 0, zero).otherwise(F.col("committed_offset"))
    else:
        start = F.coalesce(F.col("committed_offset"), zero)
    return joined.select("topic", "partition", start.alias("start_offset"))


def ledger_ranges(ledger: DataFrame) -> DataFrame:
    """(query, batch_id, topic, partition, from_offset, until_offset) of a stream's ledger, as `offset_ranges`
    gives them for a message table."""
    return ledger.groupBy("query", "batch_id", "topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"))


def admitted_ranges(ends: DataFrame, ledger: DataFrame, rate: int, seconds: float,
                    all_or_nothing: bool = True) -> DataFrame:
    """(topic, partition, from_offset, until_offset): what a run of `seconds` may read of each partition.

    `ends` holds (topic, partition, end_offset), the first offset not there yet. A partition is read from its
    committed offset (`start_offsets`) up to its end, at most rate x seconds messages of it; one that has been read
    to its end has an empty range."""
    starts = start_offsets(ends, ledger, all_or_nothing)
    most = F.col("start_offset") + F.lit(int(rate * seconds))
    last = ends.groupBy("topic", "partition").agg(F.max("end_offset").alias("end_offset"))
    return starts.join(last, ["topic", "partition"]).select(
        "topic", "partition", F.col("start_offset").alias("from_offset"),
        F.greatest("start_offset", F.least("end_offset", most)).cast("bigint").alias("until_offset"))


def ranges_json(ranges: DataFrame) -> DataFrame:
    """One row (starting_offsets, ending_offsets): the texts that Spark's Kafka batch source takes."""
    entry = F.struct(F.col("partition").cast("string").alias("k"), F.col("from_offset").alias("a"), F.col("until_offset").alias("b"))
    per_topic = ranges.groupBy("topic").agg(F.array_sort(F.collect_list(entry)).alias("parts"))
    topics = per_topic.agg(F.array_sort(F.collect_list(F.struct("topic", "parts"))).alias("topics"))

    def text(field: str):
        return F.to_json(F.map_from_entries(F.transform("topics", lambda t: F.struct(
            t["topic"], F.map_from_entries(F.transform(t["parts"], lambda e: F.struct(e["k"], e[field])))))))

    return topics.select(text("a").alias("starting_offsets"), text("b").alias("ending_offsets"))


def start_offsets_json(offsets: DataFrame, all_or_nothing: bool = True) -> DataFrame:
    """One row, `starting_offsets`: {"topic": {"partition": offset, ...}, ...}.

    `offsets` holds (topic, partition, start_offset), or (topic, partition,
    committed_offset) with nulls for partitions without one; those are treated
    as in `start_offsets`, in the same single pass."""
    name = "start_offset" if "start_offset" in offsets.columns else "committed_offset"
    entry = F.struct(F.col("partition").cast("string").alias("k"), F.col(name).alias("v"))
    per_topic = offsets.groupBy("topic").agg(F.array_sort(F.collect_list(entry)).alias("offsets"))
    topics = per_topic.agg(F.array_sort(F.collect_list(F.struct("topic", "offsets"))).alias("topics"))
    lost = F.exists("topics", lambda t: F.exists(t["offsets"], lambda e: e["v"].isNull()))
    zero = F.lit(0).cast("bigint")

    def start(e):
        found = F.coalesce(e["v"], zero)
        return F.struct(e["k"], F.when(lost, zero).otherwise(found) if all_or_nothing else found)

    whole = F.transform("topics", lambda t: F.struct(
        t["topic"], F.map_from_entries(F.transform(t["offsets"], start))))
    return topics.select(F.to_json(F.map_from_entries(whole)).alias("starting_offsets"))
