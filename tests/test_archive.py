"""Archive: minute folders, CRLF line ends, read-back and day load."""

import glob
import os

from pyspark.sql import functions as F

from logtide.operators import archive as A


def _msgs(spark):
    rows = [("line %d" % i, f"2024-01-0{1 + i % 2} 10:2{i % 3}:05") for i in range(12)]
    return spark.createDataFrame(rows, "value string, t string").select(
        "value", F.col("t").cast("timestamp").alias("timestamp"))


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_write_read_crlf(spark, scratch):
    path = scratch("archive")
    A.write_archive(_msgs(spark), path)
    dirs = sorted({os.path.relpath(os.path.dirname(f), _local(path)) for f in glob.glob(_local(path) + "/*/*/*/*.txt")})
    assert dirs == [f"ym=202401/dd=0{d}/hhmm=102{m}" for d in (1, 2) for m in range(3)]
    raw = b"".join(open(f, "rb").read() for f in glob.glob(_local(path) + "/*/*/*/*.txt"))
    assert raw.count(b"\r\n") == 12 and raw.count(b"\n") == 12
    back = A.read_archive(spark, path)
    assert sorted(r.value for r in back.collect()) == sorted(r.value for r in _msgs(spark).collect())
    assert set(back.schema.names) == {"value", "ym", "dd", "hhmm"}
    assert dict(back.dtypes)["dd"] == "string"


def test_minute_as_dir_and_load(spark, scratch):
    path = scratch("archive_hm")
    A.write_archive(_msgs(spark), path, minute_as_dir=True)
    assert glob.glob(_local(path) + "/ym=202401/dd=01/hh=10/mm=20/*.txt")
    table = A.load_archive(spark, path, scratch("table"), minute_as_dir=True, day="20240102")
    assert {r.dt for r in table.select("dt").distinct().collect()} == {"20240102"}
    assert table.count() == 6


def test_load_overwrites_only_loaded_day(spark, scratch):
    path, table = scratch("archive"), scratch("table")
    A.write_archive(_msgs(spark), path)
    A.load_archive(spark, path, table)                       # both days
    again = A.load_archive(spark, path, table, day="20240101")   # reload one day
    counts = {r.dt: r.n for r in again.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"20240101": 6, "20240102": 6}


def test_day_read_lists_only_that_day(spark, scratch):
    path = scratch("archive")
    A.write_archive(_msgs(spark), path)
    df = A.read_archive(spark, path, day="20240102")
    assert df.inputFiles() and all("/ym=202401/dd=02/" in f for f in df.inputFiles())
    assert {r.dd for r in df.select("dd").distinct().collect()} == {"02"} and df.count() == 6


def test_load_several_days(spark, scratch):
    path, table = scratch("archive"), scratch("table")
    A.write_archive(_msgs(spark), path)
    out = A.load_archive(spark, path, table, day=["20240101", "20240102"])
    assert {r.dt: r.n for r in out.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()} == \
        {"20240101": 6, "20240102": 6}


def test_messages_with_line_breaks_and_missing_days(spark, scratch):
    path = scratch("archive")
    rows = spark.createDataFrame([("a\nb",), ("c\rd",), ("",)], "value string") \
        .withColumn("timestamp", F.lit("2024-01-01 10:20:00").cast("timestamp"))
    A.write_archive(rows, path)
    A.write_archive(rows, path)                                   # the same minute again: appended
    assert sorted(r.value for r in A.read_archive(spark, path).collect()) == ["", "", "a\nb", "a\nb", "c\rd", "c\rd"]
    assert A.read_archive(spark, path, day=["20240101", "20240102"]).count() == 6
    assert A.read_archive(spark, path, day="20240103").count() == 0


def test_few_files_per_minute(spark, scratch):
    """Shuffled input with a hot minute: files follow the rows' sizes, not tasks times minutes."""
    path = scratch("archive")
    rows = spark.range(0, 20000, numPartitions=16).select(
        F.concat(F.lit("line "), "id").alias("value"),
        F.timestamp_seconds(F.lit(1704103200) + F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30) * 60).alias("timestamp"))
    A.write_archive(rows, path)
    files = glob.glob(_local(path) + "/*/*/*/*.txt")
    assert len({os.path.dirname(f) for f in files}) == 21 and len(files) <= 32
    assert A.read_archive(spark, path).count() == 20000
