"""Tables whose content lives in Spark's state store.

A table is a folder; each query that feeds it is a writer with a folder of its own:

  <table>/<writer>/checkpoint/   Spark's checkpoint: source offsets, commit log and the state
  <table>/<writer>/closed/       (uniques) what the state has let go of, written by Spark's file sink

Nothing else is kept. A batch is committed when Spark's commit log says so, a replayed batch starts from the state
of the batch before it, and readers ask the state data source for the last committed batch. State is held by the
RocksDB provider with changelog checkpointing: memory is bounded and a batch uploads only what it changed.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATE_CONF = {
    # rows of one key merge into sessions before the exchange, so a hot hour sends some rows a task, not all its rows
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# What the state data source says of a query that has committed nothing yet.
NOTHING_COMMITTED = {"STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_LOG_UNAVAILABLE"}


def use_state_store(spark: SparkSession) -> None:
    """New stateful queries of this session use RocksDB, and merge sessions early, unless the session says otherwise."""
    named = spark.conf.getAll
    for key, value in STATE_CONF.items():
        if key not in named:
            spark.conf.set(key, value)


def checkpoint_of(table: str, writer: str) -> str:
    return f"{table.rstrip('/')}/{writer}/checkpoint"


def closed_of(table: str, writer: str) -> str:
    return f"{table.rstrip('/')}/{writer}/closed"


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def writers(spark: SparkSession, table: str) -> list[str]:
    """Names of the queries that feed a table."""
    fs, p = _files(spark, table)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if exists(spark, f"{checkpoint_of(table, n)}/metadata"))


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """(key, value, partition_id) of a query's state after its last committed batch; None before the first."""
    try:
        return spark.read.format("statestore").load(checkpoint)
    except PySparkException as e:
        if e.getCondition() in NOTHING_COMMITTED:
            return None
        raise


# ---- counters -------------------------------------------------------------------------------------------------------

COUNTS_SCHEMA = "row_key string, click_count bigint"


def counter_rows(spark: SparkSession, table: str) -> DataFrame:
    """(row_key, click_count) of every writer of a counter table."""
    out = spark.createDataFrame([], COUNTS_SCHEMA)
    for w in writers(spark, table):
        state = read_state(spark, checkpoint_of(table, w))
        if state is not None:
            out = out.unionByName(state.select("key.row_key", F.col("value.count").alias("click_count")))
    return out


# ---- sessions -------------------------------------------------------------------------------------------------------

SESSION_SCHEMA = ("hour_key string, begins timestamp, expires timestamp, sketch binary, last_write timestamp, "
                  "n_rows bigint")


def session_rows(spark: SparkSession, table: str) -> DataFrame:
    """SESSION_SCHEMA and writer: each writer's sessions, those in its state and those it has closed.

    The state is read first: a session that closes in between is seen twice, never missed, and counts once."""
    schema = f"{SESSION_SCHEMA}, writer string"
    out = spark.createDataFrame([], schema)
    for w in writers(spark, table):
        state = read_state(spark, checkpoint_of(table, w))
        found = [] if state is None else [state.select(
            "key.hour_key", F.col("value.session_window.start").alias("begins"),
            F.col("value.session_window.end").alias("expires"), F.col("value.buf").alias("sketch"),
            F.col("value.max").alias("last_write"), F.col("value.count").alias("n_rows"))]
        if exists(spark, closed_of(table, w)):
            found.append(spark.read.schema(SESSION_SCHEMA).parquet(closed_of(table, w)))
        for rows in found:
            out = out.unionByName(rows.withColumn("writer", F.lit(w)))
    last = F.struct("expires", "sketch", "last_write", "n_rows")
    return (out.groupBy("writer", "hour_key", "begins").agg(F.max_by(last, "expires").alias("last"))
            .select("writer", "hour_key", "begins", "last.*"))


def merged_sessions(sessions: DataFrame) -> DataFrame:
    """(hour_key, begins, expires, sketch, last_write, n_rows): overlapping sessions of an hour become one.

    A key that any writer renews before it expires lives on with all its users; one written again only after it
    expired starts anew."""
    by_start = Window.partitionBy("hour_key").orderBy("begins", "expires", "writer")
    before = F.max("expires").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    marked = sessions.withColumn("_new", F.when(before.isNull() | (F.col("begins") >= before), 1).otherwise(0))
    chained = marked.withColumn("_chain", F.sum("_new").over(by_start))
    return chained.groupBy("hour_key", "_chain").agg(
        F.min("begins").alias("begins"), F.max("expires").alias("expires"),
        F.hll_union_agg("sketch", True).alias("sketch"), F.max("last_write").alias("last_write"),
        F.sum("n_rows").alias("n_rows")).drop("_chain")
