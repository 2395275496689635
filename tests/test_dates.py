"""Date functions: fixture cases, SQL surface, pushdown, and a differential
check against the JDK's SimpleDateFormat + Calendar (the reference's classes)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logtide.functions import dates as D

TS = "2019/06/21 10:20:30"   # a Friday


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_fixture_values(spark):
    s = F.lit(TS)
    assert one(spark, D.day_begin_str(s)) == 1561075200000
    assert one(spark, D.day_begin_str(s, offset=-1)) == 1560988800000
    assert one(spark, D.week_begin_str(s)) == 1560643200000
    assert one(spark, D.week_begin_str(s, offset=1)) == 1561248000000
    assert one(spark, D.month_begin_str(s)) == 1559347200000
    assert one(spark, D.month_begin_str(s, offset=-1)) == 1556668800000
    assert one(spark, D.week_begin_str(F.lit("2019-06-21"), "yyyy-MM-dd", 1)) == 1561248000000
    ms = F.lit(1561112430123)
    assert one(spark, D.format_time(ms, "yyyyMMdd-HH")) == "20190621-10"
    assert one(spark, D.format_time(ms, "yyyyMM/dd/HHmm")) == "201906/21/1020"
    assert one(spark, D.format_week_begin(ms, "yyyy-MM-dd")) == "2019-06-16"
    assert one(spark, D.format_time_str(F.lit("1561112430123"), "yyyy-MM-dd")) == "2019-06-21"


def test_sunday_is_its_own_week_begin(spark):
    assert one(spark, D.week_begin_str(F.lit("2019/06/16 00:00:00"))) == 1560643200000


@pytest.mark.parametrize("bad", ["2019/13/01 00:00:00", "junk", None])
def test_bad_text_gives_null(spark, bad):
    s = F.lit(bad).cast("string")
    assert one(spark, D.day_begin_str(s)) is None
    assert one(spark, D.week_begin_str(s)) is None
    assert one(spark, D.month_begin_str(s)) is None
    assert one(spark, D.format_time_str(F.lit("12.5x"), "yyyy")) is None


def test_now_forms_are_consistent(spark):
    row = spark.range(1).select(
        D.day_begin().alias("d"), D.day_begin(offset=1).alias("d1"),
        D.week_begin().alias("w"), D.month_begin().alias("m"),
        D.to_ms(F.current_timestamp()).alias("now")).first()
    assert row.d <= row.now < row.d + D.MS_PER_DAY
    assert row.d1 - row.d == D.MS_PER_DAY
    assert row.w <= row.d and row.m <= row.d


def test_sql_functions_inline_and_match(spark):
    D.register_sql_functions(spark)
    r = spark.sql(f"""SELECT day_begin_str('{TS}') a, day_begin_str('{TS}', off => -1) b,
        week_begin_str('{TS}', 'yyyy/MM/dd HH:mm:ss', 1) c, month_begin(timestamp'2019-06-21 10:20:30', -1) d,
        format_time(1561112430123, 'yyyyMMdd-HH') e, format_time(1561112430123, 'yyyy-MM-dd', 7) f,
        format_time_str('1561112430123', 'HHmm') g, day_begin(off => 0) <= unix_millis(current_timestamp()) h""").first()
    assert (r.a, r.b, r.c, r.d) == (1561075200000, 1560988800000, 1561248000000, 1556668800000)
    assert (r.e, r.f, r.g, r.h) == ("20190621-10", "2019-06-16", "1020", True)
    plan = spark.sql("SELECT week_begin(cast(id AS TIMESTAMP)) FROM range(3)")._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "week_begin" not in plan.lower().replace("week_begin(", "")


def test_range_predicates_push_down(spark):
    from conftest import SF0001
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    for pred in (D.in_day("ts", "2024-01-05", ntz=True), D.in_week("ts", "2024-01-05", ntz=True),
                 D.in_month("ts", "2024-01-05", ntz=True)):
        plan = ev.where(pred).select("event_id")._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    # in_week covers Sun 2023-12-31 .. Sat 2024-01-06
    got = ev.where(D.in_week("ts", "2024-01-05", ntz=True)).count()
    want = ev.where((F.col("ts") >= "2023-12-31") & (F.col("ts") < "2024-01-07")).count()
    assert got == want
    lo = spark.range(1).select(F.lit("2024-01-31").cast("date").alias("d"))
    assert lo.where(D.in_month("d", "2024-02-10", offset=-1)).count() == 1


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_differential_against_jdk(spark, zone):
    """Same instants through the JDK classes the reference uses and through ours."""
    jvm = spark.sparkContext._jvm
    TimeZone = jvm.java.util.TimeZone
    old_default = TimeZone.getDefault()
    old_session = spark.conf.get("spark.sql.session.timeZone")
    rnd = random.Random(7)
    instants = [rnd.randrange(946_684_800_000, 1_893_456_000_000) for _ in range(40)]
    offsets = [rnd.randrange(-14, 14) for _ in instants]
    try:
        TimeZone.setDefault(TimeZone.getTimeZone(zone))
        spark.conf.set("spark.sql.session.timeZone", zone)
        Cal = jvm.java.util.Calendar

        def jdk(ms, off, kind):
            sdf = jvm.java.text.SimpleDateFormat("yyyy/MM/dd 00:00:00")
            day = sdf.parse(sdf.format(jvm.java.util.Date(ms)))
            c = Cal.getInstance()
            c.setTime(day)
            if kind == "day":
                c.add(Cal.DAY_OF_MONTH, off)
            elif kind == "week":
                c.add(Cal.DAY_OF_MONTH, -(c.get(Cal.DAY_OF_WEEK) - 1))
                c.add(Cal.DAY_OF_MONTH, off * 7)
            else:
                m = jvm.java.text.SimpleDateFormat("yyyy/MM/01 00:00:00")
                c.setTime(m.parse(m.format(day)))
                c.add(Cal.MONTH, off)
            return c.getTime().getTime()

        df = spark.createDataFrame(list(zip(instants, offsets)), "ms long, off int")
        ts = D.from_ms("ms")
        rows = df.select("ms", "off", D.day_begin(ts, F.col("off")).alias("day"),
                         D.week_begin(ts, F.col("off")).alias("week"),
                         D.month_begin(ts, F.col("off")).alias("month")).collect()
        for r in rows:
            assert r.day == jdk(r.ms, r.off, "day"), (zone, r)
            assert r.week == jdk(r.ms, r.off, "week"), (zone, r)
            assert r.month == jdk(r.ms, r.off, "month"), (zone, r)
    finally:
        TimeZone.setDefault(old_default)
        spark.conf.set("spark.sql.session.timeZone", old_session)


def test_archive_path_layouts(spark):
    ts = D.from_ms(F.lit(1561112430123))
    assert one(spark, D.archive_path(ts)) == "/logData/201906/21/1020"
    assert one(spark, D.archive_path(ts, minute_as_dir=True)) == "/logData/201906/21/10/20"
    assert one(spark, D.hour_key(ts)) == "20190621-10"
    assert one(spark, D.date_to_string(ts)) == "2019-06-21"


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31)),
       st.integers(min_value=-3, max_value=3))
def test_range_predicates_agree_with_buckets(spark, day, offset):
    """in_day/in_week/in_month(ts, day, offset) <=> bucket(ts) == bucket(day) + offset."""
    base = dt.datetime.combine(day, dt.time())
    stamps = [base + dt.timedelta(hours=h) for h in range(-24 * 70, 24 * 70, 7)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    d = F.lit(day.isoformat()).cast("date")
    checks = {
        "day": (D.in_day("ts", day, offset), D.day_begin("ts") == D.day_begin(d, offset)),
        "week": (D.in_week("ts", day, offset), D.week_begin("ts") == D.week_begin(d, offset)),
        "month": (D.in_month("ts", day, offset), D.month_begin("ts") == D.month_begin(d, offset)),
    }
    for kind, (pred, bucket) in checks.items():
        bad = df.where(pred != bucket).count()
        assert bad == 0, (kind, day, offset)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_format_time_matches_simpledateformat(spark, zone):
    """FormatTime(ms, fmt): our date_format against the JDK formatter the reference uses."""
    jvm = spark.sparkContext._jvm
    TimeZone = jvm.java.util.TimeZone
    old_default, old_session = TimeZone.getDefault(), spark.conf.get("spark.sql.session.timeZone")
    patterns = ["yyyy-MM-dd HH:mm:ss.SSS", "yyyyMMdd-HH", "yyyyMM/dd/HHmm", "EEE, d MMM yyyy", "hh:mm a",
                "kk:mm", "D", "yyyy-MM-dd'T'HH:mm:ssZ", "yyyy-MM-dd HH:mm XXX"]
    rnd = random.Random(11)
    instants = [rnd.randrange(0, 2_000_000_000_000) for _ in range(25)] + [0, 1561112430123]
    try:
        TimeZone.setDefault(TimeZone.getTimeZone(zone))
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(m,) for m in instants], "ms long")
        cols = [D.format_time("ms", p).alias(f"p{i}") for i, p in enumerate(patterns)]
        for r in df.select("ms", *cols).collect():
            for i, p in enumerate(patterns):
                sdf = jvm.java.text.SimpleDateFormat(p, jvm.java.util.Locale.US)
                want = sdf.format(jvm.java.util.Date(r.ms))
                assert r[f"p{i}"] == want, (zone, p, r.ms)
    finally:
        TimeZone.setDefault(old_default)
        spark.conf.set("spark.sql.session.timeZone", old_session)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def test_ntz_to_ms_ignores_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(dt.datetime(2018, 11, 4, 0, 30, 1, 999999),), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000),),
                                    (dt.datetime(2024, 1, 30, 23, 57, 12, 194062),)], "ts timestamp_ntz")
        got = [r.ms for r in df.select(D.ntz_to_ms("ts").alias("ms")).collect()]
        assert got == [1541291401999, -500, 1706659032194]
        plan = df.select(D.ntz_to_ms("ts"))._jdf.queryExecution().optimizedPlan().toString()
        assert " as timestamp)" not in plan          # no conversion through the session zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_edges_before_epoch_and_across_years(spark):
    ts = D.parse_time(F.lit("1969/12/31 23:59:59"))          # a Wednesday
    assert one(spark, D.day_begin(ts)) == -86_400_000
    assert one(spark, D.week_begin(ts)) == -4 * 86_400_000    # Sunday 1969-12-28
    assert one(spark, D.month_begin(ts, 1)) == 0              # 1970-01-01
    assert one(spark, D.format_time(F.lit(-1), "yyyy-MM-dd HH:mm:ss.SSS")) == "1969-12-31 23:59:59.999"
    jan = D.parse_time(F.lit("2020/01/31 12:00:00"))
    assert one(spark, D.month_begin_ts(jan, -13).cast("string")) == "2018-12-01 00:00:00"
    assert one(spark, D.month_begin_ts(jan, 11).cast("string")) == "2020-12-01 00:00:00"
    assert one(spark, D.week_begin_ts(D.parse_time(F.lit("2021/01/02 23:00:00")), 0).cast("string")) == "2020-12-27 00:00:00"
    sat, sun = D.parse_time(F.lit("2019/06/22 23:59:59")), D.parse_time(F.lit("2019/06/23 00:00:00"))
    assert one(spark, D.week_begin(sun)) - one(spark, D.week_begin(sat)) == 7 * 86_400_000


def test_per_row_patterns(spark):
    df = spark.createDataFrame([("2019-06-21", "yyyy-MM-dd"), ("21/06/2019", "dd/MM/yyyy"), ("x", "yyyy")],
                               "s string, f string")
    got = [r.v for r in df.select(D.day_begin_str("s", F.col("f")).alias("v")).collect()]
    assert got == [1561075200000, 1561075200000, None]
    got = [r.v for r in df.select(D.format_time(F.lit(1561112430123), F.col("f")).alias("v")).collect()]
    assert got == ["2019-06-21", "21/06/2019", "2019"]
