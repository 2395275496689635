"""HLL uniques: bound against exact counts, hour->day merge, retention."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from logtide.operators import uniques as U
from logtide.sources.messages import as_messages
from logtide.sources.tables import csv_lines, load_table


def _uh(spark):
    ev = load_table(spark, SF001, "events")
    return U.user_hours(as_messages(csv_lines(ev), "user-csv", 3))


def test_hourly_and_daily_within_bound(spark):
    uh = _uh(spark)
    sk = U.hourly_sketches(uh)
    est = U.sketch_estimates(sk)
    exact = uh.groupBy("hour_key").agg(F.count_distinct("user_id").alias("uv"))
    bad = est.join(exact, "hour_key").where(~U.within_bound(F.col("uv_est"), F.col("uv"))).count()
    assert bad == 0 and est.count() == exact.count() == 720
    days = U.merge_sketches(sk, U.daily_key(), "day").select("day", F.hll_sketch_estimate("sketch").alias("e"))
    dexact = uh.groupBy(U.daily_key().alias("day")).agg(F.count_distinct("user_id").alias("uv"))
    j = days.join(dexact, "day")
    assert j.count() == 30 and j.where(~U.within_bound(F.col("e"), F.col("uv"))).count() == 0


def test_large_cardinality_bound(spark):
    df = spark.range(200_000).select(F.lit("h").alias("hour_key"), F.col("id").cast("string").alias("user_id"),
                                     F.current_timestamp().alias("write_ts"))
    e = U.sketch_estimates(U.hourly_sketches(df.repartition(8))).first().uv_est
    assert abs(e - 200_000) <= 0.03 * 200_000


def test_retention_is_from_last_write(spark):
    t = dt.datetime(2024, 1, 10, 12)
    rows = [("a", t - dt.timedelta(hours=30)), ("a", t - dt.timedelta(hours=2)), ("b", t - dt.timedelta(hours=25))]
    df = spark.createDataFrame(rows, "hour_key string, write_ts timestamp").withColumn("user_id", F.lit("u"))
    kept = U.retained(U.hourly_sketches(df), F.lit(t).cast("timestamp"))
    assert [r.hour_key for r in kept.collect()] == ["a"]


def test_processing_time_hours(spark):
    msgs = spark.createDataFrame([("u1,x", dt.datetime(2020, 1, 1))], "value string, timestamp timestamp")
    r = U.user_hours(msgs, processing_time=True).first()
    assert r.user_id == "u1" and r.hour_key != "20200101-00"
