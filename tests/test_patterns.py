"""JDK patterns: formatting and lenient parsing against the JDK formatter the reference uses."""

import random

import pytest
from pyspark.sql import functions as F

from logtide.functions import dates as D
from logtide.functions.patterns import is_plain, pattern_runs

ZONES = ["UTC", "Asia/Shanghai", "America/New_York"]


@pytest.fixture
def zoned(spark):
    """Set the JVM's and the session's zone; both are put back."""
    zones = spark.sparkContext._jvm.java.util.TimeZone
    old, session = zones.getDefault(), spark.conf.get("spark.sql.session.timeZone")

    def use(zone):
        zones.setDefault(zones.getTimeZone(zone))
        spark.conf.set("spark.sql.session.timeZone", zone)

    yield use
    zones.setDefault(old)
    spark.conf.set("spark.sql.session.timeZone", session)


def _jdk(spark, pattern):
    return spark.sparkContext._jvm.java.text.SimpleDateFormat(pattern, spark.sparkContext._jvm.java.util.Locale.US)


PATTERNS = ["u", "w", "ww", "W", "F", "Y", "YY", "YYYY", "YYYY-'W'ww-u", "yyyy-MM-dd F W", "S", "SS", "SSSS", "D", "DDD", "DDDD",
            "yyyyyyyy", "HHH:mmm:sss", "kkk KKK hhh", "MMMMM", "L", "LL", "EEEEE", "aa", "ddd", "GG yyyy", "'week' w 'of' YYYY",
            "yyyy''MM 'o''clock' HH", "y", "yy", "yyy", "Z ZZZZZ", "X XX XXX", "[yyyy] {MM} #dd", "yyyy年MM月dd日 u", "''", "--"]


@pytest.mark.parametrize("zone", ZONES)
def test_every_letter_formats_as_the_jdk(spark, zoned, zone):
    rng = random.Random(7)
    days = [86_400_000 * (365 * y + y // 4 + d) + 3_600_000 * rng.randrange(24) for y in range(26, 60, 3) for d in (-4, -3, -2, -1, 0, 1, 2, 5, 6, 7)]
    instants = days + [rng.randrange(0, 2_500_000_000_000) for _ in range(40)] + [0, 999, 1561112430123]
    zoned(zone)
    df = spark.createDataFrame([(m,) for m in instants], "ms long")
    rows = df.select("ms", *[D.format_time("ms", p).alias(f"p{i}") for i, p in enumerate(PATTERNS)]).collect()
    for i, p in enumerate(PATTERNS):
        sdf = _jdk(spark, p)
        for r in rows:
            assert r[f"p{i}"] == sdf.format(spark.sparkContext._jvm.java.util.Date(r.ms)), (zone, p, r.ms)


def test_plain_patterns_stay_one_call(spark):
    assert is_plain("yyyy-MM-dd HH:mm:ss.SSS") and is_plain("yyyyMM/dd/HHmm") and not is_plain("YYYY") and not is_plain("S")
    plan = spark.range(1).select(D.format_time("id", "yyyy-MM-dd'T'HH u").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format") == 1
    assert spark.range(1).select(D.format_time(F.lit(None).cast("long"), "u w")).first()[0] is None
    assert pattern_runs("yyyy''MM'x'") == [("y", 4), ("", "'"), ("M", 2), ("", "x")]
    for bad in ("b", "yyyy'", "Q"):
        with pytest.raises(ValueError):
            pattern_runs(bad)


LENIENT = {
    "yyyy/MM/dd HH:mm:ss": ["2019/13/01 00:00:00", "2019/06/21 10:20:30", "2019/00/00 25:61:61", "2019/2/30 1:2:3", "2019/6/5 7:8:9",
                            "2019/06/21 10:20:30 and more", " 2019/06/21 10:20:30", "2019/ 6/21 10:20:30", "2019/06/21T10:20:30",
                            "junk", "", "2019/06/21", "2019/40/400 99:99:99", "02019/06/21 10:20:30", "2019/-1/05 00:00:00",
                            "2019/06/21 -5:00:00", "2018/11/4 0:30:0", "2019/3/10 2:30:0", "2019/06/21 10:20:3x", "2019/06/21 10:20:"],
    "yyyy-MM-dd": ["2019-13-45", "2019-06-21", "2019-6-0", "2019-06-21T00", "2019-06", "1999-1-1", "2019--1-05", "2019-06--3"],
    "yyyyMMdd": ["20191345", "20190621", "201906211", "2019062", "2019061x"],
    "yyyyMMddHHmmss": ["20191345256199", "20190621102030", "2019062110203"],
    "dd MMM yyyy": ["31 Feb 2019", "21 June 2019", "21 jun 2019", "21 Xyz 2019"],
    "EEE, d MMM yyyy hh:mm a": ["Fri, 21 Jun 2019 12:05 AM", "Friday, 21 Jun 2019 12:05 pm", "Mon, 21 Jun 2019 13:65 PM"],
    "yyyy D": ["2019 400", "2019 0", "2020 366"],
    "yyyy-MM-dd kk:mm": ["2019-06-21 24:30", "2019-06-21 25:00"],
    "yyyy-MM-dd KK a": ["2019-06-21 11 PM", "2019-06-21 12 PM"],
    "HH:mm:ss.SSS": ["10:20:30.1234", "1:2:3.4"],
    "yy/M/d": ["19/6/21", "2019/6/21", "89/1/1", "2007/1/1"],
}


@pytest.mark.parametrize("zone", ZONES)
def test_lenient_parsing_as_the_jdk(spark, zoned, zone):
    zoned(zone)
    wrong = []
    for pattern, texts in LENIENT.items():
        df = spark.createDataFrame([(t,) for t in texts], "s string")
        for r in df.select("s", F.unix_millis(D.parse_time("s", pattern, lenient=True)).alias("ms")).collect():
            try:
                want = _jdk(spark, pattern).parse(r.s).getTime()
            except Exception:
                want = None
            if r.ms != want:
                wrong.append((pattern, r.s, r.ms, want))
    assert not wrong, (zone, wrong)


def test_lenient_begins(spark):
    df = spark.createDataFrame([("2019/13/01 00:00:00", "2019-13-45")], "s string, d string")
    got = df.select(D.day_begin_str("s", lenient=True), D.day_begin_str("s"), D.week_begin_str("d", "yyyy-MM-dd", 1, lenient=True),
                    D.month_begin_str("d", "yyyy-MM-dd", lenient=True), D.day_begin_str(F.lit(None).cast("string"), lenient=True),
                    D.day_begin_str(F.lit("999999999/1/1 0:0:0"), lenient=True),
                    D.day_begin_str(F.lit("2019/999999999/1 0:0:0"), lenient=True),
                    D.day_begin_str(F.lit("2019/1/99999999999 0:0:0"), lenient=True)).first()
    assert tuple(got) == (1577836800000, None, 1581811200000, 1580515200000, None, None, None, None)
    with pytest.raises(ValueError):
        D.parse_time(F.lit("x"), F.lit("yyyy"), lenient=True)
    with pytest.raises(ValueError):
        D.parse_time(F.lit("x"), "yyyy z", lenient=True)
