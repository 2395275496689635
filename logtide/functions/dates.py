"""Day / week / month bucketing with offsets, and epoch-ms formatting.

Every function returns a plain Catalyst expression (no Python UDF), so it is
code-generated, runs on the executors and can sit inside any projection,
filter or grouping key. All calendar arithmetic happens in the session time
zone (``spark.sql.session.timeZone``), which plays the part of the JVM default
zone the reference's date classes use.

Semantics (all "begin" results are epoch milliseconds, BIGINT):

* day begin   = midnight of the instant's date, plus ``offset`` days
* week begin  = midnight of the **Sunday** on or before the date, plus
  ``offset`` weeks (``date_trunc('week')`` would give Monday — not used)
* month begin = midnight of the first of the month, plus ``offset`` months
* the ``*_str`` forms parse text first with a pattern (default below);
  unparseable text or null gives null instead of failing the job;
  `lenient=True` rolls fields over as the reference's parser does

Pushdown: ``day_begin(ts) = X`` cannot reach a Parquet scan, so `in_day`,
`in_week` and `in_month` build the equivalent literal range on the raw
column, which Catalyst pushes into ``PushedFilters``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from logtide.functions.patterns import format_jdk, is_plain, parse_lenient

# The reference's default parse pattern and its day-string,
# hour-key and archive-path patterns.
DEFAULT_PATTERN = "yyyy/MM/dd HH:mm:ss"
DAY_PATTERN = "yyyy-MM-dd"
HOUR_KEY_PATTERN = "yyyyMMdd-HH"
ARCHIVE_ROOT = "/logData/"
ARCHIVE_MINUTE_PATTERN = "yyyyMM/dd/HHmm"
ARCHIVE_MINUTE_DIR_PATTERN = "yyyyMM/dd/HH/mm"

MS_PER_DAY = 86_400_000


def _col(c) -> Column:
    if c is None:
        return F.current_timestamp()
    if isinstance(c, Column):
        return c
    return F.col(c)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _format(ts: Column, fmt: str | Column) -> Column:
    """Formatted by a literal pattern, with all the JDK's letters, or by a per-row one, with Spark's."""
    if isinstance(fmt, Column):
        return F.call_function("date_format", ts, fmt)
    return F.date_format(ts, fmt) if is_plain(fmt) else format_jdk(ts, fmt)


def to_ms(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP column (session zone for local times)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def ntz_to_ms(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ wall clock read as UTC, truncated.

    Built from the wall clock's own fields (day number, hour, minute, seconds
    with fraction), so no session-zone conversion is involved; a timestamp
    difference would first cast the NTZ value to the session zone."""
    c = _col(ts)
    return (F.unix_date(c.cast("date")).cast("bigint") * MS_PER_DAY
            + F.hour(c).cast("bigint") * 3_600_000 + F.minute(c).cast("bigint") * 60_000
            + F.floor(F.date_part(F.lit("SECOND"), c) * 1000).cast("bigint"))


def from_ms(ms) -> Column:
    """TIMESTAMP instant of epoch milliseconds."""
    return F.timestamp_millis(_col(ms))


def parse_time(text, fmt: str | Column = DEFAULT_PATTERN, lenient: bool = False) -> Column:
    """Parse text with a datetime pattern; null when it does not parse.

    `lenient=True` (literal patterns) lets fields roll over, 2019/13/01 being 2020/01/01, and ignores what follows."""
    if lenient:
        if isinstance(fmt, Column):
            raise ValueError("lenient parsing needs a literal pattern")
        return parse_lenient(_col(text), fmt)
    return F.try_to_timestamp(_col(text), _lit(fmt))


# ---- date-valued building blocks -------------------------------------------------

def day_start(ts=None, offset=0) -> Column:
    """DATE of the instant's day, plus `offset` days."""
    return F.date_add(_col(ts).cast("date"), _lit(offset))


def week_start(ts=None, offset=0) -> Column:
    """DATE of the Sunday on or before the instant's day, plus `offset` weeks."""
    d = _col(ts).cast("date")
    sunday = F.date_sub(d, F.dayofweek(d) - 1)
    return F.date_add(sunday, _lit(offset) * 7)


def month_start(ts=None, offset=0) -> Column:
    """DATE of the first of the instant's month, plus `offset` months."""
    return F.add_months(F.trunc(_col(ts).cast("date"), "MM"), _lit(offset))


def _date_ms(d: Column) -> Column:
    return F.unix_millis(d.cast("timestamp"))


# ---- the UDF surface: epoch-ms results ------------------------------------------

def day_begin(ts=None, offset=0) -> Column:
    """DayBegin() / DayBegin(n) / DayBegin(date) / DayBegin(date, n)."""
    return _date_ms(day_start(ts, offset))


def week_begin(ts=None, offset=0) -> Column:
    """WeekBegin() / (n) / (date) / (date, n): Sunday-start weeks."""
    return _date_ms(week_start(ts, offset))


def month_begin(ts=None, offset=0) -> Column:
    """MonthBegin() / (n) / (date) / (date, n)."""
    return _date_ms(month_start(ts, offset))


def day_begin_str(text, fmt: str | Column = DEFAULT_PATTERN, offset=0, lenient: bool = False) -> Column:
    """DayBegin(str) / (str, n) / (str, fmt) / (str, fmt, n)."""
    return day_begin(parse_time(text, fmt, lenient), offset)


def week_begin_str(text, fmt: str | Column = DEFAULT_PATTERN, offset=0, lenient: bool = False) -> Column:
    """WeekBegin(str) / (str, n) / (str, fmt) / (str, fmt, n)."""
    return week_begin(parse_time(text, fmt, lenient), offset)


def month_begin_str(text, fmt: str | Column = DEFAULT_PATTERN, offset=0, lenient: bool = False) -> Column:
    """MonthBegin(str) / (str, n) / (str, fmt) / (str, fmt, n)."""
    return month_begin(parse_time(text, fmt, lenient), offset)


def format_time(ms, fmt: str | Column) -> Column:
    """FormatTime(long ms, fmt)."""
    return _format(from_ms(ms), fmt)


def format_time_str(ms_text, fmt: str | Column) -> Column:
    """FormatTime(String ms, fmt): text that is not a whole number gives null."""
    return _format(from_ms(_col(ms_text).try_cast("bigint")), fmt)


def format_week_begin(ms, fmt: str | Column) -> Column:
    """FormatTime(long ms, fmt, week): formats the begin of ms's (Sunday) week."""
    return _format(week_start(from_ms(ms)).cast("timestamp"), fmt)


# ---- timestamp-valued helpers (the date class's Date results) --------------------

def day_begin_ts(ts=None, offset=0, as_type: str = "timestamp") -> Column:
    """Day begin (+offset days) as a timestamp of type `as_type`."""
    return day_start(ts, offset).cast(as_type)


def week_begin_ts(ts=None, offset=0, as_type: str = "timestamp") -> Column:
    """Sunday week begin (+offset weeks) as a timestamp of type `as_type`."""
    return week_start(ts, offset).cast(as_type)


def month_begin_ts(ts=None, offset=0, as_type: str = "timestamp") -> Column:
    """Month begin (+offset months) as a timestamp of type `as_type`."""
    return month_start(ts, offset).cast(as_type)


# ---- string keys used by the jobs ------------------------------------------------

def date_to_string(ts) -> Column:
    """yyyy-MM-dd of an instant (the counters' day string)."""
    return F.date_format(_col(ts), DAY_PATTERN)


def hour_key(ts=None) -> Column:
    """yyyyMMdd-HH of an instant; of now when ts is None."""
    return F.date_format(_col(ts), HOUR_KEY_PATTERN)


def archive_path(ts, minute_as_dir: bool = False) -> Column:
    """/logData/yyyyMM/dd/HHmm (or .../HH/mm) of an instant."""
    pattern = ARCHIVE_MINUTE_DIR_PATTERN if minute_as_dir else ARCHIVE_MINUTE_PATTERN
    return F.concat(F.lit(ARCHIVE_ROOT), F.date_format(_col(ts), pattern))


# ---- pushdown-friendly range predicates ------------------------------------------

def _as_date(day) -> _dt.date:
    if isinstance(day, _dt.datetime):
        return day.date()
    if isinstance(day, _dt.date):
        return day
    return _dt.date.fromisoformat(str(day)[:10])


def _range(column, lo: _dt.date, hi: _dt.date, ntz: bool) -> Column:
    c = _col(column)
    cast = "timestamp_ntz" if ntz else "timestamp"
    lo_lit = F.lit(lo.isoformat()).cast(cast)
    hi_lit = F.lit(hi.isoformat()).cast(cast)
    return (c >= lo_lit) & (c < hi_lit)


def in_day(column, day, offset: int = 0, ntz: bool = False) -> Column:
    """column falls in the day `day` (+offset days): ts >= begin AND ts < next begin."""
    lo = _as_date(day) + _dt.timedelta(days=offset)
    return _range(column, lo, lo + _dt.timedelta(days=1), ntz)


def in_week(column, day, offset: int = 0, ntz: bool = False) -> Column:
    """column falls in the Sunday-start week containing `day` (+offset weeks)."""
    d = _as_date(day)
    sunday = d - _dt.timedelta(days=(d.weekday() + 1) % 7) + _dt.timedelta(weeks=offset)
    return _range(column, sunday, sunday + _dt.timedelta(days=7), ntz)


def in_month(column, day, offset: int = 0, ntz: bool = False) -> Column:
    """column falls in the month containing `day` (+offset months)."""
    d = _as_date(day)
    index = d.year * 12 + (d.month - 1) + offset
    lo = _dt.date(index // 12, index % 12 + 1, 1)
    nxt = index + 1
    hi = _dt.date(nxt // 12, nxt % 12 + 1, 1)
    return _range(column, lo, hi, ntz)


# ---- SQL surface -----------------------------------------------------------------

_SQL_FUNCTIONS = [
    # name, signature, return type, body
    ("day_begin", "ts TIMESTAMP DEFAULT current_timestamp(), off INT DEFAULT 0", "BIGINT",
     "unix_millis(cast(date_add(cast(ts AS DATE), off) AS TIMESTAMP))"),
    ("week_begin", "ts TIMESTAMP DEFAULT current_timestamp(), off INT DEFAULT 0", "BIGINT",
     "unix_millis(cast(date_add(date_sub(cast(ts AS DATE), dayofweek(cast(ts AS DATE)) - 1), 7 * off) AS TIMESTAMP))"),
    ("month_begin", "ts TIMESTAMP DEFAULT current_timestamp(), off INT DEFAULT 0", "BIGINT",
     "unix_millis(cast(add_months(trunc(cast(ts AS DATE), 'MM'), off) AS TIMESTAMP))"),
    ("day_begin_str", f"s STRING, fmt STRING DEFAULT '{DEFAULT_PATTERN}', off INT DEFAULT 0", "BIGINT",
     "day_begin(try_to_timestamp(s, fmt), off)"),
    ("week_begin_str", f"s STRING, fmt STRING DEFAULT '{DEFAULT_PATTERN}', off INT DEFAULT 0", "BIGINT",
     "week_begin(try_to_timestamp(s, fmt), off)"),
    ("month_begin_str", f"s STRING, fmt STRING DEFAULT '{DEFAULT_PATTERN}', off INT DEFAULT 0", "BIGINT",
     "month_begin(try_to_timestamp(s, fmt), off)"),
    # A third argument selects the begin-of-week form; its value is not used.
    ("format_time", "ms BIGINT, fmt STRING, week INT DEFAULT NULL", "STRING",
     "CASE WHEN week IS NULL THEN date_format(timestamp_millis(ms), fmt) "
     "ELSE date_format(cast(date_sub(cast(timestamp_millis(ms) AS DATE), "
     "dayofweek(cast(timestamp_millis(ms) AS DATE)) - 1) AS TIMESTAMP), fmt) END"),
    ("format_time_str", "ms STRING, fmt STRING", "STRING",
     "date_format(timestamp_millis(try_cast(ms AS BIGINT)), fmt)"),
]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the date functions as temporary SQL functions.

    SQL functions are inlined by the analyzer, so the optimized plan holds
    only built-in expressions. Named arguments work: ``day_begin(off => -1)``.
    """
    names = []
    for name, signature, returns, body in _SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}")
        names.append(name)
    return names
