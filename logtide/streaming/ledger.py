"""The offset ledger: what each committed batch of a query has read, as rows.

`OffsetLedger` is a listener: Spark reports a batch's progress after its commit, and the start and end offsets in
that report become rows (query, batch_id, source, topic, partition, from_offset, until_offset), appended to a folder
every few batches. No aggregate of the stream carries offsets. `checkpoint_ledger` derives the same rows from the
checkpoint's offset and commit logs, and `catch_up` appends those that a lost driver never reported, so ledger and
checkpoint agree after a restart. Spark keeps 100 batches of those logs by default, so the ledger must be written at
least that often.

Kafka's offsets are per topic and partition; a source with one number (a file source's log position, say) is one
partition 0 of a topic named after the field. `until_offset` is the first offset not read; `from_offset` is null
in a query's first batch, where the source chose it.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.window import Window

from logtide.operators.offsets import start_offsets
from logtide.streaming.state import exists

LEDGER_SCHEMA = ("query string, batch_id bigint, source int, topic string, partition int, from_offset bigint, "
                 "until_offset bigint")
FLUSH_EVERY = 20


def _positions(offsets) -> dict[tuple[str, int], int]:
    """{(topic, partition): first offset not read} of a source's offset, as parsed JSON."""
    if isinstance(offsets, int):
        return {("offset", 0): offsets + 1}
    out = {}
    for topic, value in (offsets or {}).items():
        if isinstance(value, dict):
            out.update({(topic, int(p)): int(o) for p, o in value.items()})
        elif isinstance(value, int):
            out[topic, 0] = value + 1                  # the last position read
    return out


def progress_rows(progress) -> list[tuple]:
    """Ledger rows of one progress report."""
    rows = []
    for number, source in enumerate(json.loads(progress.json)["sources"]):
        start, end = _positions(source["startOffset"]), _positions(source["endOffset"])
        rows += [(str(progress.id), progress.batchId, number, topic, partition, start.get((topic, partition)), until)
                 for (topic, partition), until in sorted(end.items()) if start.get((topic, partition)) != until]
    return rows


class OffsetLedger(StreamingQueryListener):
    """Appends what each committed batch has read to `folder`; add it with `spark.streams.addListener`."""

    def __init__(self, spark: SparkSession, folder: str, every: int = FLUSH_EVERY):
        self.spark, self.folder, self.every = spark, folder, every
        self._held: list[tuple] = []
        self._reports = 0
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._held += progress_rows(event.progress)
            self._reports += 1
            full = self._reports >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write what is held."""
        with self._lock:
            rows, self._held, self._reports = self._held, [], 0
        if rows:
            self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger's rows, one per query, batch, source and partition, however often they were reported."""
    if not exists(spark, folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(folder)
    return (rows.groupBy("query", "batch_id", "source", "topic", "partition")
            .agg(F.max("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")))


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, text) of the entries of a checkpoint's log."""
    entries = spark.read.text(folder, wholetext=True)
    return (entries.select(F.col("_metadata.file_name").alias("name"), "value")
            .where(F.col("name").rlike("^[0-9]+$")).select(F.col("name").cast("bigint").alias("batch_id"), "value"))


def checkpoint_ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Ledger rows of the committed batches that the checkpoint's logs still hold."""
    if not exists(spark, f"{checkpoint}/commits"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    lines = F.split("value", "\n")
    per_source = (_log(spark, f"{checkpoint}/offsets")
                  .select("batch_id", F.posexplode(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))))
                          .alias("source", "offsets")))                      # after the version and the batch's metadata
    nested = F.col("offsets").rlike(r'^\s*\{\s*"[^"]*"\s*:\s*\{')
    by_topic = F.from_json(F.when(nested, F.col("offsets")), "map<string, map<string, bigint>>")
    single = F.from_json(F.when(~nested & F.col("offsets").startswith("{"), F.col("offsets")), "map<string, bigint>")
    plain = F.when(F.col("offsets").rlike("^[0-9]+$"), F.create_map(F.lit("offset"), F.col("offsets").cast("bigint")))
    found = F.coalesce(by_topic, F.transform_values(F.coalesce(single, plain),
                                                    lambda _, v: F.create_map(F.lit("0"), v + 1)))
    topics = per_source.select("batch_id", "source", F.explode(found).alias("topic", "partitions"))
    untils = topics.select("batch_id", "source", "topic", F.explode("partitions").alias("partition", "until_offset"))
    by_batch = Window.partitionBy("source", "topic", "partition").orderBy("batch_id")
    ranges = untils.withColumn("partition", F.col("partition").cast("int")).where("until_offset IS NOT NULL").withColumn("from_offset", F.lag("until_offset").over(by_batch))
    done = ranges.join(_log(spark, f"{checkpoint}/commits").select("batch_id"), "batch_id", "left_semi")
    return (done.where(~F.col("from_offset").eqNullSafe(F.col("until_offset")))
            .select(F.lit(query).alias("query"), "batch_id", F.col("source").cast("int"), "topic", "partition",
                    "from_offset", "until_offset"))


def catch_up(spark: SparkSession, checkpoint: str, folder: str) -> int:
    """Append the committed batches of a checkpoint that the ledger lacks; returns how many rows."""
    logged = checkpoint_ledger(spark, checkpoint)
    known = read_ledger(spark, folder)
    lacking = logged.join(known.select("query", "batch_id").distinct(), ["query", "batch_id"], "left_anti")
    last = known.groupBy("query", "source", "topic", "partition").agg(F.max("until_offset").alias("reached"))
    rows = (lacking.join(last, ["query", "source", "topic", "partition"], "left")
            .withColumn("from_offset", F.coalesce("from_offset", F.when(F.col("reached") < F.col("until_offset"), F.col("reached"))))
            .drop("reached").collect())          # at most the retained batches times the topics' partitions
    if rows:
        columns = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
        spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], LEDGER_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(folder)
    return len(rows)


def ledger_start_offsets(spark: SparkSession, folder: str, partitions: DataFrame) -> dict:
    """``{topic: {partition: offset}}`` to start a new query from what the ledger's queries have committed.

    Same all-or-nothing rule as the reference's offset lookup: if any partition has no committed offset, every
    partition starts at 0. `partitions` holds (topic, partition) rows."""
    out: dict = {}
    for row in start_offsets(partitions, read_ledger(spark, folder)).collect():   # one row per topic-partition
        out.setdefault(row.topic, {})[str(row.partition)] = int(row.start_offset)
    return out
