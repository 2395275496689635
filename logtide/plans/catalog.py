"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables (`events`, `lineitem`) in full and turns
them into log lines / messages with the adapters in `logtide.sources`, then
runs the engine's operators on those lines. Oracles compute the same answer
directly from the tables in DuckDB. Column names are aliased identically on
both sides.

Time: the tables hold TIMESTAMP_NTZ wall clocks that the oracle reads as UTC,
and the reference works in the JVM default zone; queries therefore pin the
session zone to UTC (`_prepare`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions import dates as D
from logtide.functions.logs import csv_field
from logtide.operators import archive as A
from logtide.operators import counters as C
from logtide.operators import offsets as O
from logtide.operators import rolls as L
from logtide.operators import routing as R
from logtide.operators import uniques as U
from logtide.session import scratch_path
from logtide.sources.messages import as_messages, read_text_lines
from logtide.sources.tables import csv_lines, load_table, mixed_lines, startup_lines
from logtide.streaming.jobs import user_sessions

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

APP_TOPIC = "app-log"
CSV_TOPIC = "user-csv"
KAFKA_PARTITIONS = 3
# The simulated commit point: batches (days) before it have been processed and
# their offsets committed; the start offsets are computed for the whole topic.
LEDGER_CUTOFF = "2024-01-15"


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


def _prepare(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _events(spark: SparkSession, sf: str, cols=None) -> DataFrame:
    """The events scan."""
    _prepare(spark)
    return load_table(spark, sf, "events", cols)


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    _prepare(spark)
    return load_table(spark, sf, "lineitem", ["l_shipdate", "l_linenumber"])


def _instant(col: str = "ts") -> Column:
    """Event instant: the NTZ wall clock read as UTC (ms precision)."""
    return D.from_ms(D.ntz_to_ms(col))


def _offset5() -> Column:
    return (F.col("event_id") % 5 - 2).cast("int")


def _lines(df: DataFrame) -> DataFrame:
    return df.select("value")


# SQL fragments shared by oracles ---------------------------------------------------
_MS = "(epoch_us(ts) // 1000)"
_KIND = "CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'page' ELSE 'startup' END"
_CITY = "'city_' || (props->>'$.k')"
_SUNDAY = "(cast(ts AS DATE) - cast(dayofweek(ts) AS INTEGER))"
_SATURDAY = f"({_SUNDAY} + 6)"
_OFF5 = "cast(event_id % 5 - 2 AS INTEGER)"
_STARTUP_JSON = (
    "CASE WHEN event_type = 'error' THEN json_object('userId', cast(user_id AS VARCHAR), "
    "'appId', 'app' || (user_id % 3), 'appPlatform', CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END, "
    "'appVersion', '1.0.' || (user_id % 4), 'startTimeInMs', (epoch_us(ts) // 1000), "
    "'activeTimeInMs', cast(floor(value * 1000) AS BIGINT))::VARCHAR "
    "ELSE json_object('userId', cast(user_id AS VARCHAR), "
    "'appId', 'app' || (user_id % 3), 'appPlatform', CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END, "
    "'appVersion', '1.0.' || (user_id % 4), 'startTimeInMs', (epoch_us(ts) // 1000), "
    "'activeTimeInMs', cast(floor(value * 1000) AS BIGINT), 'city', 'city_' || (props->>'$.k'))::VARCHAR END")
_MESSAGES = (
    "SELECT strftime(ts, '%Y-%m-%d') AS batch, 'app-log' AS topic, cast(event_id % 3 AS INTEGER) AS \"partition\", "
    "row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS \"offset\" FROM events")


# ---- counters (AGG-1/2, SNK-1/2, PRJ-3/4) -----------------------------------------

@register("city_click_counter", f"""
SELECT strftime(ts, '%Y-%m-%d') || '_' || {_CITY} AS row_key, count(*) AS click_count
FROM events WHERE event_type <> 'error' GROUP BY 1""")
def city_click_counter(spark, sf):
    return C.city_click_counts(_lines(startup_lines(_events(spark, sf))), C.DATE_CITY)


@register("city_click_counter_v2", f"""
SELECT {_CITY} || strftime(ts, '%Y-%m-%d') AS row_key, count(*) AS click_count
FROM events WHERE event_type <> 'error' GROUP BY 1""")
def city_click_counter_v2(spark, sf):
    return C.city_click_counts(_lines(startup_lines(_events(spark, sf))), C.CITY_DATE)


# ---- routing / validation / decode (FLT-*, PRJ-1/2/5/6) ---------------------------

@register("log_type_counts", f"""
SELECT {_KIND} AS log_kind, count(*) AS n FROM events GROUP BY 1""")
def log_type_counts(spark, sf):
    return R.route_counts(R.parse_logs(_lines(mixed_lines(_events(spark, sf)))))


@register("log_type_filter", f"""
SELECT cast(user_id AS VARCHAR) AS userId, {_KIND} AS log_kind FROM events""")
def log_type_filter(spark, sf):
    ev = _events(spark, sf)
    lines = _lines(mixed_lines(ev)).unionByName(_lines(csv_lines(ev)))
    return R.parse_logs(R.keep_log_lines(lines)).select("userId", "log_kind")


@register("startup_valid", f"""
SELECT cast(user_id AS VARCHAR) AS userId, {_KIND} AS log_kind, {_MS} AS event_ms
FROM events WHERE event_type <> 'signup'""")
def startup_valid(spark, sf):
    parsed = R.parse_logs(R.keep_log_lines(_lines(mixed_lines(_events(spark, sf)))))
    return R.keep_valid(parsed).select(
        "userId", "log_kind", F.coalesce("startTimeInMs", "createTimeInMs").alias("event_ms"))


@register("city_line_filter", f"""
SELECT cast(user_id AS VARCHAR) AS userId, {_MS} AS event_ms
FROM events WHERE event_type IN ('purchase', 'click')""")
def city_line_filter(spark, sf):
    parsed = R.parse_logs(R.keep_city_lines(_lines(mixed_lines(_events(spark, sf)))))
    return parsed.select("userId", F.coalesce("startTimeInMs", "createTimeInMs").alias("event_ms"))


@register("startup_decode", f"""
SELECT cast(user_id AS VARCHAR) AS userId, 'app' || (user_id % 3) AS appId,
       CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS appPlatform,
       '1.0.' || (user_id % 4) AS appVersion, {_MS} AS startTimeInMs,
       cast(floor(value * 1000) AS BIGINT) AS activeTimeInMs,
       CASE WHEN event_type = 'error' THEN NULL ELSE {_CITY} END AS city,
       date_trunc('millisecond', ts) AS start_ts
FROM events""")
def startup_decode(spark, sf):
    parsed = R.parse_logs(_lines(startup_lines(_events(spark, sf))))
    return parsed.where(F.col("log_kind") == "startup").select(
        "userId", "appId", "appPlatform", "appVersion", "startTimeInMs", "activeTimeInMs", "city",
        D.from_ms("startTimeInMs").cast("timestamp_ntz").alias("start_ts"))


_K = "cast(props->>'$.k' AS INTEGER)"


@register("log_rejects", """
SELECT 'no_marker' AS reason, count(*) AS n FROM events
UNION ALL
SELECT 'missing_city' AS reason, count(*) AS n FROM events WHERE event_type = 'signup'""")
def log_rejects(spark, sf):
    """The reject view over JSON logs mixed with CSV lines: reason, count."""
    ev = _events(spark, sf)
    lines = _lines(mixed_lines(ev)).unionByName(_lines(csv_lines(ev)))
    return R.rejected_logs(R.parse_logs(lines)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("log_rejects_strict", f"""
WITH r AS (SELECT CASE WHEN event_id % 5 = 0 THEN 'unknown_field' WHEN event_type = 'signup' THEN 'missing_city' END AS reason,
                  {_KIND} AS log_kind FROM events)
SELECT reason, log_kind, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1, 2""")
def log_rejects_strict(spark, sf):
    """Strict decoding: lines with a field that their bean lacks are rejected whatever their kind. Every fifth line
    has one more field."""
    lines = _lines(mixed_lines(_events(spark, sf)).withColumn("value", F.expr(
        "CASE WHEN event_id % 5 = 0 THEN concat('{\"channel\":{\"city\":1},', substr(value, 2)) ELSE value END")))
    rejected = R.rejected_logs(R.reject_unknown(R.parse_logs(lines)))
    return rejected.groupBy("reason", "log_kind").agg(F.count(F.lit(1)).alias("n"))


@register("page_views", f"""
SELECT cast(user_id AS VARCHAR) AS userId, 'app' || (user_id % 3) AS appId,
       {_K} % 7 + 1 AS pageViewCntInSession, 'page_' || ({_K} % 10) AS currentPage,
       {_K} % 5 AS pageVisitIndex, 'page_' || (({_K} + 1) % 10) AS nextPage,
       cast(floor(value) AS BIGINT) AS stayDurationInSecs, {_MS} AS createTimeInMs
FROM events WHERE event_type = 'view'""")
def page_views(spark, sf):
    """Typed page-visit view of the routed logs."""
    parsed = R.parse_logs(_lines(mixed_lines(_events(spark, sf))))
    return R.page_logs(parsed).select("userId", "appId", "pageViewCntInSession", "currentPage", "pageVisitIndex",
                                      "nextPage", "stayDurationInSecs", "createTimeInMs")


@register("error_views", f"""
SELECT cast(user_id AS VARCHAR) AS userId, CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS appPlatform,
       'E' || ({_K} % 5) AS errorMajor, 'detail_' || (props->>'$.k') AS errorInDetail, {_MS} AS createTimeInMs
FROM events WHERE event_type = 'error'""")
def error_views(spark, sf):
    """Typed error view of the routed logs."""
    parsed = R.parse_logs(_lines(mixed_lines(_events(spark, sf))))
    return R.error_logs(parsed).select("userId", "appPlatform", "errorMajor", "errorInDetail", "createTimeInMs")


@register("csv_user_id", """
SELECT cast(user_id AS VARCHAR) AS user_id, count(*) AS n FROM events GROUP BY 1""")
def csv_user_id(spark, sf):
    lines = _lines(csv_lines(_events(spark, sf)))
    return lines.groupBy(csv_field("value", 0).alias("user_id")).agg(F.count(F.lit(1)).alias("n"))


# ---- sources (SRC-4, SRC-6) -------------------------------------------------------

@register("text_scan", """
SELECT concat_ws(',', cast(user_id AS VARCHAR), event_type, cast(event_id AS VARCHAR),
                 cast(cast(floor(value * 100) AS BIGINT) AS VARCHAR)) AS value FROM events""")
def text_scan(spark, sf):
    path = scratch_path(spark, "text_scan")
    _lines(csv_lines(_events(spark, sf))).write.text(path)
    return read_text_lines(spark, path)


@register("message_envelope", f"""
SELECT 'app-log' AS topic, cast(event_id % 3 AS INTEGER) AS "partition",
       row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS "offset",
       {_STARTUP_JSON} AS value
FROM events""")
def message_envelope(spark, sf):
    msgs = as_messages(startup_lines(_events(spark, sf)), APP_TOPIC, KAFKA_PARTITIONS)
    return msgs.select("topic", "partition", "offset", "value")


# ---- offsets (AGG-5/6) ------------------------------------------------------------

def _app_messages(spark, sf) -> DataFrame:
    ev = _events(spark, sf, ["event_id", "ts"])
    msgs = as_messages(ev.select("event_id", "ts", F.lit("").alias("value")), APP_TOPIC, KAFKA_PARTITIONS)
    return msgs.withColumn("batch", D.date_to_string("timestamp"))


@register("offset_ranges", f"""
WITH m AS ({_MESSAGES})
SELECT batch, topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset
FROM m GROUP BY ALL""")
def offset_ranges(spark, sf):
    return O.offset_ranges(_app_messages(spark, sf), "batch")


@register("start_offsets_json", f"""
WITH m AS ({_MESSAGES}),
led AS (SELECT topic, "partition", max("offset") + 1 AS c FROM m WHERE batch < '{LEDGER_CUTOFF}' GROUP BY ALL),
parts AS (SELECT DISTINCT topic, "partition" FROM m),
j AS (SELECT p.topic, p."partition", l.c FROM parts p LEFT JOIN led l USING (topic, "partition")),
s AS (SELECT topic, "partition",
             CASE WHEN (SELECT count(*) FROM j WHERE c IS NULL) > 0 THEN 0 ELSE c END AS o FROM j),
t AS (SELECT topic, '"' || topic || '":{{' || string_agg('"' || cast("partition" AS VARCHAR) || '":' || cast(o AS VARCHAR), ','
             ORDER BY cast("partition" AS VARCHAR)) || '}}' AS body FROM s GROUP BY topic)
SELECT '{{' || string_agg(body, ',' ORDER BY topic) || '}}' AS starting_offsets FROM t""")
def start_offsets_json(spark, sf):
    # one scan, one grouped pass: per partition the offset after the last committed message
    return O.start_offsets_json(O.committed_of(_app_messages(spark, sf), F.col("batch") < LEDGER_CUTOFF))


@register("start_offsets_json_missing", f"""
WITH m AS ({_MESSAGES}),
c AS (SELECT "partition", max(CASE WHEN batch < '{LEDGER_CUTOFF}' AND "partition" <> 2 THEN "offset" + 1 END) AS c
      FROM m GROUP BY 1)
SELECT m.all_or_nothing,
       '{{"app-log":{{' || string_agg('"' || cast("partition" AS VARCHAR) || '":' ||
           cast(CASE WHEN m.all_or_nothing THEN 0 ELSE coalesce(c, 0) END AS VARCHAR), ',' ORDER BY "partition") || '}}}}' AS starting_offsets
FROM c, (VALUES (true), (false)) m(all_or_nothing) GROUP BY 1""")
def start_offsets_json_missing(spark, sf):
    """Partition 2 has committed nothing: the all-or-nothing lookup and the per-partition form."""
    done = O.committed_of(_app_messages(spark, sf), (F.col("batch") < LEDGER_CUTOFF) & (F.col("partition") != 2))
    forms = [O.start_offsets_json(done, all_or_nothing=x).select(F.lit(x).alias("all_or_nothing"), "starting_offsets")
             for x in (True, False)]
    return forms[0].unionByName(forms[1])


@register("admitted_ranges", f"""
WITH m AS ({_MESSAGES}),
e AS (SELECT topic, "partition", max("offset") + 1 AS end_offset,
             max(CASE WHEN batch < '{LEDGER_CUTOFF}' THEN "offset" + 1 END) AS c FROM m GROUP BY ALL)
SELECT topic, "partition", c AS from_offset, least(end_offset, c + 1000)::BIGINT AS until_offset FROM e""")
def admitted_ranges(spark, sf):
    """What a bounded run of 10 s at 100 messages a second may read of each partition, from its committed offset on."""
    msgs = _app_messages(spark, sf)
    ends = msgs.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    done = O.offset_ranges(msgs.where(F.col("batch") < LEDGER_CUTOFF))
    return O.admitted_ranges(ends, done, rate=100, seconds=10)


# ---- string keys and paths (SCL-1..4) ---------------------------------------------

@register("date_to_string", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def date_to_string(spark, sf):
    return _events(spark, sf, ["event_id", "ts"]).select("event_id", D.date_to_string(_instant()).alias("day"))


@register("hour_key", "SELECT event_id, strftime(ts, '%Y%m%d-%H') AS hour_key FROM events")
def hour_key(spark, sf):
    return _events(spark, sf, ["event_id", "ts"]).select("event_id", D.hour_key(_instant()).alias("hour_key"))


@register("archive_paths", "SELECT event_id, '/logData/' || strftime(ts, '%Y%m/%d/%H%M') AS path FROM events")
def archive_paths(spark, sf):
    return _events(spark, sf, ["event_id", "ts"]).select("event_id", D.archive_path(_instant()).alias("path"))


@register("archive_paths_hm", "SELECT event_id, '/logData/' || strftime(ts, '%Y%m/%d/%H/%M') AS path FROM events")
def archive_paths_hm(spark, sf):
    return _events(spark, sf, ["event_id", "ts"]).select(
        "event_id", D.archive_path(_instant(), minute_as_dir=True).alias("path"))


@register("archive_rolls", """
WITH RECURSIVE m AS (SELECT epoch_us(ts) // 1000 AS ms, count(*) AS n FROM events GROUP BY 1),
starts AS (
  SELECT min(ms) AS s FROM m
  UNION ALL
  SELECT (SELECT min(ms) FROM m WHERE ms >= starts.s + 60000) FROM starts WHERE s IS NOT NULL),
files AS (SELECT s, lead(s) OVER (ORDER BY s) AS e FROM starts WHERE s IS NOT NULL)
SELECT '/logData/' || strftime(make_timestamp(s * 1000), '%Y%m/%d/%H%M') AS path, s AS begins_ms, max(ms) AS ends_ms,
       sum(n)::BIGINT AS n_lines
FROM files JOIN m ON ms >= s AND (e IS NULL OR ms < e) GROUP BY s""")
def archive_rolls(spark, sf):
    """The files a 60 s rolling archiver writes: each begins with the first message 60 s or more after the last began."""
    ev = _events(spark, sf, ["event_id", "ts"])
    return L.archive_rolls(as_messages(ev.select("event_id", "ts", F.lit("").alias("value")), APP_TOPIC, KAFKA_PARTITIONS))


# ---- timestamp-valued begins (SCL-5..10) ------------------------------------------

def _ts_query(fn, with_offset: bool):
    def q(spark, sf):
        ev = _events(spark, sf, ["event_id", "ts"])
        off = _offset5() if with_offset else 0
        return ev.select("event_id", fn(_instant(), off, as_type="timestamp_ntz").alias("begin_ts"))
    return q


for _name, _fn, _off, _sql in [
    ("day_begin_ts", D.day_begin_ts, False, "date_trunc('day', ts)::TIMESTAMP"),
    ("day_begin_ts_offset", D.day_begin_ts, True, f"(cast(ts AS DATE) + {_OFF5})::TIMESTAMP"),
    ("week_begin_ts", D.week_begin_ts, False, f"{_SUNDAY}::TIMESTAMP"),
    ("week_begin_ts_offset", D.week_begin_ts, True, f"({_SUNDAY} + 7 * {_OFF5})::TIMESTAMP"),
    ("month_begin_ts", D.month_begin_ts, False, "date_trunc('month', ts)::TIMESTAMP"),
    ("month_begin_ts_offset", D.month_begin_ts, True, f"(date_trunc('month', ts) + to_months({_OFF5}))::TIMESTAMP"),
]:
    register(_name, f"SELECT event_id, {_sql} AS begin_ts FROM events")(_ts_query(_fn, _off))


# ---- the UDF surface, as grouped jobs (UDF-D3..8, W3..8, M3..8) --------------------
# events: Date and String(default pattern) forms; lineitem: offsets by line number
# and String forms with an explicit pattern.

_LI_OFF = "(l_linenumber - 4)"
_DEFAULT_PARSE = "strptime(strftime(ts, '%Y/%m/%d %H:%M:%S'), '%Y/%m/%d %H:%M:%S')"


def _grouped(name: str, out: str, table: str, spark_expr, sql_expr: str):
    def q(spark, sf):
        if table == "events":
            df = _events(spark, sf, ["event_id", "ts"])
        else:
            df = _lineitem(spark, sf)
        return df.groupBy(spark_expr().alias(out)).agg(F.count(F.lit(1)).alias("n"))
    sql = f"SELECT epoch_ms(({sql_expr})::TIMESTAMP) AS {out}, count(*) AS n FROM {table} GROUP BY 1"
    register(name, sql)(q)


def _default_str() -> Column:
    return F.date_format(_instant(), D.DEFAULT_PATTERN)


def _iso_str() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM-dd")


def _li_off() -> Column:
    return F.col("l_linenumber") - 4


_li_sunday = "(cast(l_shipdate AS DATE) - cast(dayofweek(l_shipdate) AS INTEGER))"
_ev_sunday_p = f"(cast({_DEFAULT_PARSE} AS DATE) - cast(dayofweek({_DEFAULT_PARSE}) AS INTEGER))"

_grouped("day_begin", "day_begin_ms", "events", lambda: D.day_begin(_instant()), "date_trunc('day', ts)")
_grouped("day_begin_offset", "day_begin_ms", "lineitem", lambda: D.day_begin("l_shipdate", _li_off()),
         f"cast(l_shipdate AS DATE) + {_LI_OFF}")
_grouped("day_begin_str", "day_begin_ms", "events", lambda: D.day_begin_str(_default_str()),
         f"date_trunc('day', {_DEFAULT_PARSE})")
_grouped("day_begin_str_offset", "day_begin_ms", "events",
         lambda: D.day_begin_str(_default_str(), offset=_offset5()),
         f"cast({_DEFAULT_PARSE} AS DATE) + {_OFF5}")
_grouped("day_begin_fmt", "day_begin_ms", "lineitem", lambda: D.day_begin_str(_iso_str(), "yyyy-MM-dd"),
         "date_trunc('day', l_shipdate)")
_grouped("day_begin_fmt_offset", "day_begin_ms", "lineitem",
         lambda: D.day_begin_str(_iso_str(), "yyyy-MM-dd", _li_off()),
         f"cast(l_shipdate AS DATE) + {_LI_OFF}")

_grouped("week_begin", "week_begin_ms", "events", lambda: D.week_begin(_instant()), _SUNDAY)
_grouped("week_begin_offset", "week_begin_ms", "lineitem", lambda: D.week_begin("l_shipdate", _li_off()),
         f"{_li_sunday} + 7 * {_LI_OFF}")
_grouped("week_begin_str", "week_begin_ms", "events", lambda: D.week_begin_str(_default_str()), _ev_sunday_p)
_grouped("week_begin_str_offset", "week_begin_ms", "events",
         lambda: D.week_begin_str(_default_str(), offset=_offset5()), f"{_ev_sunday_p} + 7 * {_OFF5}")
_grouped("week_begin_fmt", "week_begin_ms", "lineitem", lambda: D.week_begin_str(_iso_str(), "yyyy-MM-dd"),
         _li_sunday)
_grouped("week_begin_fmt_offset", "week_begin_ms", "lineitem",
         lambda: D.week_begin_str(_iso_str(), "yyyy-MM-dd", _li_off()), f"{_li_sunday} + 7 * {_LI_OFF}")

_grouped("month_begin", "month_begin_ms", "events", lambda: D.month_begin(_instant()), "date_trunc('month', ts)")
_grouped("month_begin_offset", "month_begin_ms", "lineitem", lambda: D.month_begin("l_shipdate", _li_off()),
         f"date_trunc('month', l_shipdate) + to_months({_LI_OFF})")
_grouped("month_begin_str", "month_begin_ms", "events", lambda: D.month_begin_str(_default_str()),
         f"date_trunc('month', {_DEFAULT_PARSE})")
_grouped("month_begin_str_offset", "month_begin_ms", "events",
         lambda: D.month_begin_str(_default_str(), offset=_offset5()),
         f"date_trunc('month', {_DEFAULT_PARSE}) + to_months({_OFF5})")
_grouped("month_begin_fmt", "month_begin_ms", "lineitem",
         lambda: D.month_begin_str(_iso_str(), "yyyy-MM-dd"), "date_trunc('month', l_shipdate)")
_grouped("month_begin_fmt_offset", "month_begin_ms", "lineitem",
         lambda: D.month_begin_str(_iso_str(), "yyyy-MM-dd", _li_off()),
         f"date_trunc('month', l_shipdate) + to_months({_LI_OFF})")


# ---- pushdown range predicates (in_day / in_week / in_month) -------------------------

RANGE_DAY = "1996-01-10"   # a Wednesday inside the lineitem ship dates


@register("shipments_in_ranges", f"""
SELECT 'day' AS bucket, count(*) AS n FROM lineitem WHERE cast(l_shipdate AS DATE) = DATE '{RANGE_DAY}'
UNION ALL
SELECT 'week' AS bucket, count(*) AS n FROM lineitem
 WHERE cast(l_shipdate AS DATE) - cast(dayofweek(l_shipdate) AS INTEGER)
     = DATE '{RANGE_DAY}' - cast(dayofweek(DATE '{RANGE_DAY}') AS INTEGER)
UNION ALL
SELECT 'month' AS bucket, count(*) AS n FROM lineitem WHERE date_trunc('month', l_shipdate) = date_trunc('month', DATE '{RANGE_DAY}')""")
def shipments_in_ranges(spark, sf):
    """Rows in the day / Sunday-week / month of a date, as literal ranges that
    reach the Parquet scan (PushedFilters), not as bucket functions per row."""
    preds = {"day": D.in_day("l_shipdate", RANGE_DAY, ntz=True), "week": D.in_week("l_shipdate", RANGE_DAY, ntz=True),
             "month": D.in_month("l_shipdate", RANGE_DAY, ntz=True)}
    # one scan of the covering range (a week can reach over the month's end)
    li = _lineitem(spark, sf).where(preds["month"] | preds["week"])
    counts = li.agg(*[F.count_if(pred).alias(name) for name, pred in preds.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("bucket"), F.col(name).alias("n")) for name in preds])))


# ---- now-relative forms (UDF-D1/2, W1/2, M1/2): invariants per offset ---------------

_NOW_ORACLE = f"SELECT {_OFF5} AS n, true AS ok, count(*) AS n_rows FROM events GROUP BY 1"


def _time_of_day_zero(ms: Column) -> Column:
    return F.date_format(D.from_ms(ms), "HH:mm:ss.SSS") == F.lit("00:00:00.000")


def _now_query(kind: str):
    def q(spark, sf):
        ev = _events(spark, sf, ["event_id"])
        n = _offset5()
        now_ms = D.to_ms(F.current_timestamp())
        if kind == "day":
            v0, vn = D.day_begin(), D.day_begin(offset=n)
            ok = ((v0 <= now_ms) & (now_ms < v0 + D.MS_PER_DAY)
                  & (F.datediff(F.to_date(D.from_ms(vn)), F.to_date(D.from_ms(v0))) == n))
        elif kind == "week":
            v0, vn = D.week_begin(), D.week_begin(offset=n)
            ok = ((v0 <= now_ms) & (now_ms < v0 + 7 * D.MS_PER_DAY)
                  & (F.dayofweek(D.from_ms(v0)) == 1)
                  & (F.datediff(F.to_date(D.from_ms(vn)), F.to_date(D.from_ms(v0))) == 7 * n))
        else:
            v0, vn = D.month_begin(), D.month_begin(offset=n)
            ok = ((v0 <= now_ms) & (F.dayofmonth(D.from_ms(v0)) == 1)
                  & (F.date_format(D.from_ms(v0), "yyyy-MM") == F.date_format(F.current_timestamp(), "yyyy-MM"))
                  & (F.months_between(F.to_date(D.from_ms(vn)), F.to_date(D.from_ms(v0))) == n))
        ok = ok & _time_of_day_zero(v0) & _time_of_day_zero(vn)
        return ev.groupBy(n.alias("n")).agg(F.bool_and(ok).alias("ok"), F.count(F.lit(1)).alias("n_rows"))
    return q


for _kind in ("day", "week", "month"):
    register(f"{_kind}_begin_now", _NOW_ORACLE)(_now_query(_kind))


@register("hour_key_now", "SELECT true AS ok, count(*) AS n_rows FROM events")
def hour_key_now(spark, sf):
    """Hour key of now (processing time): parses back to the hour containing now."""
    ev = _events(spark, sf, ["event_id"])
    key = D.hour_key()
    begin = F.try_to_timestamp(key, F.lit(D.HOUR_KEY_PATTERN))
    now = F.current_timestamp()
    ok = (begin <= now) & (now < begin + F.expr("INTERVAL 1 HOUR")) & (F.length(key) == 11)
    return ev.agg(F.bool_and(ok).alias("ok"), F.count(F.lit(1)).alias("n_rows"))


# ---- formatting (UDF-F1..3) ---------------------------------------------------------

_FMT_MS = "yyyy-MM-dd HH:mm:ss.SSS"


@register("format_time", "SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS formatted FROM events")
def format_time(spark, sf):
    ev = _events(spark, sf, ["event_id", "ts"])
    return ev.select("event_id", D.format_time(D.ntz_to_ms("ts"), _FMT_MS).alias("formatted"))


@register("format_time_str", "SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS formatted FROM events")
def format_time_str(spark, sf):
    ev = _events(spark, sf, ["event_id", "ts"])
    return ev.select("event_id", D.format_time_str(D.ntz_to_ms("ts").cast("string"), _FMT_MS).alias("formatted"))


@register("format_time_week", f"SELECT event_id, strftime({_SUNDAY}::TIMESTAMP, '%Y-%m-%d %H:%M') AS formatted FROM events")
def format_time_week(spark, sf):
    ev = _events(spark, sf, ["event_id", "ts"])
    return ev.select("event_id", D.format_week_begin(D.ntz_to_ms("ts"), "yyyy-MM-dd HH:mm").alias("formatted"))


@register("format_time_letters", f"""
SELECT event_id, isodow(ts)::VARCHAR AS u, ((day(ts) - 1) // 7 + 1)::VARCHAR AS f, month(ts) || '.' || day(ts) AS m_d,
       lpad(((dayofyear({_SATURDAY}) - 1) // 7 + 1)::VARCHAR, 2, '0') AS ww, year({_SATURDAY})::VARCHAR AS year_of_week,
       ((day(ts) + dayofweek(date_trunc('month', ts)) - 1) // 7 + 1)::VARCHAR AS w_of_month,
       lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 4, '0') AS ssss,
       year({_SATURDAY}) || '-W' || ((dayofyear({_SATURDAY}) - 1) // 7 + 1) || '-' || isodow(ts) || ' o''clock' AS mixed
FROM events""")
def format_time_letters(spark, sf):
    """FormatTime with the pattern letters that Spark's formatter refuses or reads in another sense."""
    ev, ms = _events(spark, sf, ["event_id", "ts"]), D.ntz_to_ms("ts")
    patterns = {"u": "u", "f": "F", "m_d": "M.d", "ww": "ww", "year_of_week": "YYYY", "w_of_month": "W", "ssss": "SSSS",
                "mixed": "YYYY-'W'w-u 'o''clock'"}
    return ev.select("event_id", *[D.format_time(ms, p).alias(n) for n, p in patterns.items()])


_LENIENT_TEXT = "concat_ws('/', year(ts), month(ts) + event_id % 30, day(ts) + event_id % 50)"


@register("begin_lenient", """
WITH d AS (SELECT *, date_trunc('year', ts) + to_months((month(ts) + event_id % 30 - 1)::INTEGER)
                  + to_days((day(ts) + event_id % 50 - 1)::INTEGER) AS t FROM events)
SELECT event_id, epoch_ms((t::DATE)::TIMESTAMP) AS day_ms,
       epoch_ms((t::DATE - dayofweek(t)::INTEGER + 7)::TIMESTAMP) AS next_week_ms,
       epoch_ms(date_trunc('month', t)::TIMESTAMP) AS month_ms, NULL::BIGINT AS strict_ms
FROM d WHERE month(ts) + event_id % 30 > 12""")
def begin_lenient(spark, sf):
    """Day, week and month begin of text whose month and day lie beyond their range: rolled over, strictly null."""
    ev = _events(spark, sf, ["event_id", "ts"]).where(F.month("ts") + F.col("event_id") % 30 > 12)
    text = F.concat(F.expr(_LENIENT_TEXT), F.lit(" 25:00:00 and so on"))
    day = D.day_begin_str(text, "yyyy/M/d", lenient=True)
    return ev.select("event_id", day.alias("day_ms"), D.week_begin_str(text, "yyyy/M/d", 1, lenient=True).alias("next_week_ms"),
                     D.month_begin_str(text, "yyyy/M/d", lenient=True).alias("month_ms"),
                     D.day_begin_str(text, "yyyy/M/d").alias("strict_ms"))


@register("week_begin_sql", f"SELECT epoch_ms({_SUNDAY}::TIMESTAMP) AS week_begin_ms, count(*) AS n FROM events GROUP BY 1")
def week_begin_sql(spark, sf):
    """The SQL surface: registered temporary functions called from spark.sql."""
    ev = _events(spark, sf, ["ts"])
    D.register_sql_functions(spark)
    ev.select(_instant().alias("ts")).createOrReplaceTempView("logtide_event_times")
    return spark.sql("SELECT week_begin(ts) AS week_begin_ms, count(*) AS n FROM logtide_event_times GROUP BY 1")


@register("date_functions_sql", f"""
SELECT event_id, epoch_ms(date_trunc('day', ts)::TIMESTAMP) AS day_ms,
       epoch_ms((date_trunc('month', ts) - INTERVAL 1 MONTH)::TIMESTAMP) AS last_month_ms,
       epoch_ms((cast(ts AS DATE) + 1)::TIMESTAMP) AS next_day_str_ms,
       epoch_ms(({_SUNDAY} + 7)::TIMESTAMP) AS next_week_str_ms,
       epoch_ms(date_trunc('month', ts)::TIMESTAMP) AS month_str_ms,
       strftime(ts, '%Y%m%d-%H') AS hour_text, strftime({_SUNDAY}, '%Y-%m-%d') AS sunday_text,
       strftime(ts, '%Y/%m/%d') AS day_text FROM events""")
def date_functions_sql(spark, sf):
    """Every registered SQL function that takes a time, called from spark.sql."""
    ev = _events(spark, sf, ["event_id", "ts"])
    D.register_sql_functions(spark)
    ev.select("event_id", _instant().alias("ts"), D.ntz_to_ms("ts").alias("ms"),
              F.date_format(_instant(), "yyyy-MM-dd").alias("s")).createOrReplaceTempView("logtide_event_days")
    return spark.sql("""
        SELECT event_id, day_begin(ts) AS day_ms, month_begin(ts, -1) AS last_month_ms,
               day_begin_str(s, 'yyyy-MM-dd', 1) AS next_day_str_ms, week_begin_str(s, 'yyyy-MM-dd', off => 1) AS next_week_str_ms,
               month_begin_str(s, 'yyyy-MM-dd') AS month_str_ms, format_time(ms, 'yyyyMMdd-HH') AS hour_text,
               format_time(ms, 'yyyy-MM-dd', 1) AS sunday_text, format_time_str(cast(ms AS STRING), 'yyyy/MM/dd') AS day_text
        FROM logtide_event_days""")


# ---- roll-ups of clicks by the buckets (table-level use of the UDFs) ---------------

for _name, _bucket, _out, _sql in [
    ("clicks_by_day", lambda: D.day_begin("start_ts"), "day_begin_ms", "date_trunc('day', ts)"),
    ("clicks_by_week", lambda: D.week_begin("start_ts"), "week_begin_ms", _SUNDAY),
    ("clicks_by_month", lambda: D.month_begin("start_ts"), "month_begin_ms", "date_trunc('month', ts)"),
]:
    def _q(spark, sf, _bucket=_bucket, _out=_out):
        return C.clicks_by(_lines(startup_lines(_events(spark, sf))), _bucket(), _out)
    register(_name, f"SELECT epoch_ms(({_sql})::TIMESTAMP) AS {_out}, count(*) AS clicks "
                    f"FROM events WHERE event_type <> 'error' GROUP BY 1")(_q)


# ---- unique users (AGG-3/4, SNK-3/4) ------------------------------------------------

def _user_hours(spark, sf) -> DataFrame:
    ev = _events(spark, sf)
    msgs = as_messages(csv_lines(ev), CSV_TOPIC, KAFKA_PARTITIONS)
    return U.user_hours(msgs)


_HOURLY_EXACT = "SELECT strftime(ts, '%Y%m%d-%H') AS hour_key, count(DISTINCT user_id) AS uv FROM events GROUP BY 1"


@register("hourly_uv_exact", _HOURLY_EXACT)
def hourly_uv_exact(spark, sf):
    return U.distinct_users(_user_hours(spark, sf)).groupBy("hour_key").agg(F.count(F.lit(1)).alias("uv"))


_HOURLY_OK = "SELECT strftime(ts, '%Y%m%d-%H') AS hour_key, count(DISTINCT user_id) AS uv, true AS ok FROM events GROUP BY 1"


def _checked(estimates: DataFrame, uh: DataFrame) -> DataFrame:
    """(hour_key, uv, ok): estimates (hour_key, est) made from the raw rows, against an exact count in its own branch."""
    exact = U.distinct_users(uh).groupBy("hour_key").agg(F.count(F.lit(1)).alias("uv"))
    return estimates.join(exact, "hour_key").select(
        "hour_key", "uv", U.within_bound(F.col("est"), F.col("uv")).alias("ok"))


@register("hourly_uv_approx", _HOURLY_OK)
def hourly_uv_approx(spark, sf):
    uh = _user_hours(spark, sf)
    est = uh.groupBy("hour_key").agg(F.approx_count_distinct("user_id", 0.01).alias("est"))   # rsd 0.01 -> 2^14 registers
    return _checked(est, uh)


@register("hourly_uv_hll", _HOURLY_OK)
def hourly_uv_hll(spark, sf):
    uh = _user_hours(spark, sf)
    return _checked(U.sketch_estimates(U.hourly_sketches(uh)).withColumnRenamed("uv_est", "est"), uh)


@register("daily_uv_merged", "SELECT strftime(ts, '%Y%m%d') AS day, count(DISTINCT user_id) AS uv, true AS ok FROM events GROUP BY 1")
def daily_uv_merged(spark, sf):
    """Day estimates come only from merging the hour sketches; the exact
    day count (for the bound check) dedupes (day, user) separately."""
    uh = _user_hours(spark, sf)
    days = U.merge_sketches(U.hourly_sketches(uh), U.daily_key(), "day") \
        .select("day", F.hll_sketch_estimate("sketch").alias("est"))
    exact = U.distinct_users(uh, U.daily_key(), "day").groupBy("day").agg(F.count(F.lit(1)).alias("uv"))
    return exact.join(days, "day").select("day", "uv", U.within_bound(F.col("est"), F.col("uv")).alias("ok"))


@register("hourly_uv_retained", """
WITH h AS (SELECT strftime(ts, '%Y%m%d-%H') AS hour_key, count(DISTINCT user_id) AS uv,
                  max(epoch_us(ts) // 1000) AS lw FROM events GROUP BY 1)
SELECT hour_key, uv, true AS ok FROM h
WHERE lw + 86400000 > (SELECT max(epoch_us(ts) // 1000) FROM events)""")
def hourly_uv_retained(spark, sf):
    uh = _user_hours(spark, sf)
    sketches = U.hourly_sketches(uh)
    as_of = uh.select(F.max("write_ts")).scalar()
    kept = U.sketch_estimates(U.retained(sketches, as_of, "1 day")).withColumnRenamed("uv_est", "est")
    return _checked(kept, uh)


@register("hourly_uv_sessions", """
SELECT strftime(ts, '%Y%m%d-%H') AS hour_key, min(epoch_us(ts) // 1000) AS begins_ms,
       max(epoch_us(ts) // 1000) + 86400000 AS expires_ms, count(*) AS n_rows, count(DISTINCT user_id) AS uv, true AS ok
FROM events GROUP BY 1""")
def hourly_uv_sessions(spark, sf):
    """The life of every hour key, from its first write until a day after its last: the uniques job's sessions."""
    msgs = as_messages(csv_lines(_events(spark, sf)), CSV_TOPIC, KAFKA_PARTITIONS)
    lives = user_sessions(msgs, "1 day")
    est = lives.select("hour_key", F.unix_millis("begins").alias("begins_ms"), F.unix_millis("expires").alias("expires_ms"),
                       "n_rows", F.hll_sketch_estimate("sketch").alias("est"))
    checked = _checked(est.select("hour_key", "est"), U.user_hours(msgs))
    return est.drop("est").join(checked, "hour_key")


# ---- archive (SNK-5/7) -------------------------------------------------------------

@register("archive_load", f"""
SELECT strftime(ts, '%Y%m%d') AS dt, {_KIND} AS log_kind, count(*) AS n FROM events GROUP BY ALL""")
def archive_load(spark, sf):
    ev = _events(spark, sf)
    msgs = as_messages(mixed_lines(ev), APP_TOPIC, KAFKA_PARTITIONS)
    archive = scratch_path(spark, "archive")
    A.write_archive(msgs, archive)
    table = A.load_archive(spark, archive, scratch_path(spark, "archive_table"))
    return table.groupBy("dt", "log_kind").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
