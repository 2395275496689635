"""Clicks per (event day, city): the two row-key layouts of the counter table.

The reference increments one external counter cell per log line. Here the
count is a grouped aggregation: partial counts per row key are combined inside
each input partition before the shuffle (HashAggregate partial -> exchange on
row_key -> final), so a hot city/day costs one row per partition on the wire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.dates import DAY_PATTERN
from logtide.operators.routing import keep_city_lines, keep_log_lines, parse_logs

DATE_CITY = "date_city"   # yyyy-MM-dd + '_' + city   (row family StatisticData:clickCount)
CITY_DATE = "city_date"   # city + yyyy-MM-dd          (row family info:count)


def _row_key_sql(layout: str) -> str:
    day = f"date_format(start_ts, '{DAY_PATTERN}')"
    if layout == DATE_CITY:
        return f"concat({day}, '_', city)"
    if layout == CITY_DATE:
        return f"concat(city, {day})"
    raise ValueError(f"unknown row-key layout {layout!r}")


def click_row_key(layout: str = DATE_CITY) -> Column:
    """Row key of a row with `city` and `start_ts` columns."""
    return F.expr(_row_key_sql(layout))


# Countable rows, per layout (SQL over parse_logs output):
#  date-first job: passed the type filter and the required-field validation,
#                  is a startup log, and has a start time
#  city-first job: (after the 'city' substring filter) any well-formed line with
#                  a city and a start time, marker or not, except page and error
#                  logs; no other validation
_COUNTABLE_SQL = {
    DATE_CITY: "reject_reason IS NULL AND log_kind = 'startup' AND startTimeInMs IS NOT NULL",
    CITY_DATE: "coalesce(log_kind, 'startup') = 'startup' AND NOT malformed AND city IS NOT NULL "
               "AND startTimeInMs IS NOT NULL",
}
_COUNTED_FIELDS = ("city", "userId", "appId", "startTimeInMs")
_COUNTED_KINDS = {DATE_CITY: ("startup",), CITY_DATE: ("startup", None)}


def _stage(lines: DataFrame, layout: str, line_col: str) -> DataFrame:
    """Parsed lines of a layout, only what the count reads."""
    return parse_logs(lines, line_col, _COUNTED_FIELDS, _COUNTED_KINDS[layout])


def click_events(lines: DataFrame, layout: str = DATE_CITY, line_col: str = "value") -> DataFrame:
    """Countable startup rows with their `start_ts` and `row_key` (one row per click)."""
    row_key = _row_key_sql(layout)
    staged = keep_log_lines(lines, line_col) if layout == DATE_CITY else keep_city_lines(lines, line_col)
    return (_stage(staged, layout, line_col).where(_COUNTABLE_SQL[layout])
            .selectExpr("*", "timestamp_millis(startTimeInMs) AS start_ts")
            .selectExpr("*", f"{row_key} AS row_key"))


def click_keys(lines: DataFrame, layout: str = DATE_CITY, line_col: str = "value") -> DataFrame:
    """Every line with its `row_key`, null where the line is not countable (a stream
    needs those too: their offsets are consumed)."""
    counted = _COUNTABLE_SQL[layout] + (f" AND contains(`{line_col}`, 'city')" if layout == CITY_DATE else "")
    return (_stage(lines, layout, line_col)
            .selectExpr("*", "timestamp_millis(startTimeInMs) AS start_ts")
            .selectExpr("*", f"CASE WHEN {counted} THEN {_row_key_sql(layout)} END AS row_key"))


def city_click_counts(lines: DataFrame, layout: str = DATE_CITY, line_col: str = "value") -> DataFrame:
    """(row_key, click_count) over a table of raw lines."""
    return (click_events(lines, layout, line_col)
            .groupBy("row_key").agg(F.count(F.lit(1)).alias("click_count")))


def clicks_by(lines: DataFrame, bucket: Column, name: str, line_col: str = "value") -> DataFrame:
    """(name, clicks) with clicks grouped by any bucket expression over `start_ts`."""
    return (click_events(lines, DATE_CITY, line_col)
            .groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("clicks")))
