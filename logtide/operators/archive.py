"""Raw-line archive in per-minute folders, and its load into a day-partitioned table.

The reference appends each message to ``/logData/yyyyMM/dd/HHmm`` (lines
ended by CRLF) and, per a comment, later loads those files into a warehouse.
Here the archive is a partitioned text table: partition columns ``ym``,
``dd`` and ``hhmm`` (or ``hh``/``mm`` for the minute-as-folder layout) give
folders ``ym=202401/dd=05/hhmm=1020/part-*.txt``. Every writer adds new part
files, so reruns and concurrent batches never rewrite a file.

Before the write the rows are rebalanced by minute folder: a minute's rows meet
in one file, small minutes share a task, and a hot minute (a third of the rows,
say) is split over several, all by the sizes that the shuffle measured.

A folder that a stream writes is committed through the file sink's log
(`_spark_metadata`), so it is always read by its root, where that log replaces
the listing and hides files of attempts that never committed; batch writes into
such a folder are refused, since the log would hide them.

`load_archive` reads the folders back (partition values kept as text), parses
the lines and overwrites only the days it loaded (dynamic partition overwrite): a
backfill. The periodic load is `jobs.archive_load_stream`, which reads each file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.routing import parse_logs

MINUTE_COLUMNS = ("ym", "dd", "hhmm")
MINUTE_DIR_COLUMNS = ("ym", "dd", "hh", "mm")
LINE_SEP = "\r\n"
STREAM_LOG = "_spark_metadata"     # folder of the streaming file sink's commit log


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def archive_columns(df: DataFrame, ts_col: str = "timestamp", minute_as_dir: bool = False) -> DataFrame:
    """Add the minute-folder partition columns of `ts_col`."""
    ts = F.col(ts_col)
    out = df.withColumn("ym", F.date_format(ts, "yyyyMM")).withColumn("dd", F.date_format(ts, "dd"))
    if minute_as_dir:
        return out.withColumn("hh", F.date_format(ts, "HH")).withColumn("mm", F.date_format(ts, "mm"))
    return out.withColumn("hhmm", F.date_format(ts, "HHmm"))


def write_archive(df: DataFrame, path: str, line_col: str = "value", ts_col: str = "timestamp",
                  minute_as_dir: bool = False) -> None:
    """Append raw lines to the minute-folder archive (CRLF line ends)."""
    parts = list(MINUTE_DIR_COLUMNS if minute_as_dir else MINUTE_COLUMNS)
    if _exists(df.sparkSession, f"{path.rstrip('/')}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream; its log would hide a batch write")
    rows = archive_columns(df, ts_col, minute_as_dir).select(F.col(line_col).alias("value"), *parts)
    (rows.hint("rebalance", *parts).sortWithinPartitions(*parts)
     .write.mode("append").partitionBy(*parts).option("lineSep", LINE_SEP).text(path))


def _archive_schema(minute_as_dir: bool) -> T.StructType:
    parts = MINUTE_DIR_COLUMNS if minute_as_dir else MINUTE_COLUMNS
    return T.StructType([T.StructField("value", T.StringType())] + [T.StructField(p, T.StringType()) for p in parts])


def read_archive(spark: SparkSession, path: str, minute_as_dir: bool = False,
                 day: str | list[str] | None = None) -> DataFrame:
    """(value, ym, dd, hhmm | hh, mm) with partition values as text, one row per archived message.

    `day` (yyyyMMdd, or a list of them) reads only those days: of a batch archive
    their folders, so listing touches no other, of a streamed one the files its
    log names for them. Days without a folder have no rows."""
    schema = _archive_schema(minute_as_dir)
    reader = spark.read.schema(schema).option("lineSep", LINE_SEP)
    if day is None:
        return reader.text(path)
    days = sorted({day} if isinstance(day, str) else set(day))
    root = path.rstrip("/")
    if _exists(spark, f"{root}/{STREAM_LOG}"):
        return reader.text(path).where(F.concat("ym", "dd").isin(days))
    folders = [f for f in (f"{root}/ym={d[:6]}/dd={d[6:8]}" for d in days) if _exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", path).text(folders)


def stream_archive(spark: SparkSession, path: str, minute_as_dir: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The archive as a stream of its files, columns as `read_archive`."""
    reader = spark.readStream.schema(_archive_schema(minute_as_dir)).option("lineSep", LINE_SEP)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def parse_archived(lines: DataFrame, minute_as_dir: bool = False) -> DataFrame:
    """Archived lines decoded (`parse_logs`), with their day `dt` instead of the folder columns."""
    parsed = parse_logs(lines.withColumn("dt", F.concat("ym", "dd")), "value")
    return parsed.drop(*(MINUTE_DIR_COLUMNS if minute_as_dir else MINUTE_COLUMNS))


def load_archive(spark: SparkSession, archive: str, table: str, minute_as_dir: bool = False,
                 day: str | list[str] | None = None) -> DataFrame:
    """Parse archived lines into a `dt`-partitioned Parquet table and return it.

    `day` (yyyyMMdd, or a list for a backfill) restricts the load to those days:
    only their folders are listed and read. Only the loaded days are overwritten.
    """
    lines = read_archive(spark, archive, minute_as_dir, day)
    out = parse_archived(lines, minute_as_dir)
    (out.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(table))
    # read back with the written schema so `dt` stays text (no type inference)
    return spark.read.schema(out.schema).parquet(table)
