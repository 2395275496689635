"""Reading the driver tables, and turning `events` rows into app-log lines.

The test tables hold no app logs, so an adapter (a pure DataFrame projection,
JVM-side `to_json`) writes one JSON line per event in the shape of the
reference's log beans. The engine then reads those *lines* like any other
source: nothing downstream looks at the original event columns except the
message id and timestamp that a Kafka envelope would carry anyway.

Adapter rules (fixed, shared with the DuckDB oracles):
  userId        = user_id as text
  appId         = 'app' || user_id % 3
  appPlatform   = 'android' when user_id is even, else 'ios'
  appVersion    = '1.0.' || user_id % 4
  startTimeInMs = epoch ms of ts (wall clock read as UTC, truncated)
  activeTimeInMs= floor(value * 1000)
  city          = 'city_' || props.k   (absent for `error` events in the
                  startup adapter; absent for `signup` in the mixed one)
Mixed adapter: `error` -> error log, `view` -> page-visit log, others -> startup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.plans.shaping import with_columns_once


def load_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table; `columns` prunes the read schema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


# epoch ms of the NTZ wall clock read as UTC, from zone-free fields (see dates.ntz_to_ms)
_MS_SQL = ("(cast(unix_date(cast(ts AS DATE)) AS BIGINT) * 86400000 + cast(hour(ts) AS BIGINT) * 3600000"
           " + cast(minute(ts) AS BIGINT) * 60000 + cast(floor(date_part('SECOND', ts) * 1000) AS BIGINT))")
_K_SQL = "get_json_object(props, '$.k')"
_BASE_SQL = ("'userId', cast(user_id AS STRING), 'appId', concat('app', cast(user_id % 3 AS STRING)), "
             "'appPlatform', CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END")


def _startup_sql(city_sql: str) -> str:
    return (f"to_json(named_struct({_BASE_SQL}, 'appVersion', concat('1.0.', cast(user_id % 4 AS STRING)), "
            f"'startTimeInMs', {_MS_SQL}, 'activeTimeInMs', cast(floor(value * 1000) AS BIGINT), "
            f"'city', {city_sql}))")


_PAGE_SQL = (f"to_json(named_struct({_BASE_SQL}, "
             f"'pageViewCntInSession', cast({_K_SQL} AS INT) % 7 + 1, "
             f"'currentPage', concat('page_', cast(cast({_K_SQL} AS INT) % 10 AS STRING)), "
             f"'pageVisitIndex', cast({_K_SQL} AS INT) % 5, "
             f"'nextPage', concat('page_', cast((cast({_K_SQL} AS INT) + 1) % 10 AS STRING)), "
             f"'stayDurationInSecs', cast(floor(value) AS BIGINT), 'createTimeInMs', {_MS_SQL}))")
_ERROR_SQL = (f"to_json(named_struct({_BASE_SQL}, "
              f"'errorMajor', concat('E', cast(cast({_K_SQL} AS INT) % 5 AS STRING)), "
              f"'errorInDetail', concat('detail_', {_K_SQL}), 'createTimeInMs', {_MS_SQL}))")
_CITY_SQL = f"concat('city_', {_K_SQL})"


def startup_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(event_id, ts, *keep, value): every event as a startup-log JSON line; no city for errors."""
    city = f"CASE WHEN event_type = 'error' THEN CAST(NULL AS STRING) ELSE {_CITY_SQL} END"
    return _lines(events, F.expr(_startup_sql(city)), keep)


def mixed_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(event_id, ts, *keep, value): error/page/startup JSON lines by event type; no city for signups."""
    city = f"CASE WHEN event_type = 'signup' THEN CAST(NULL AS STRING) ELSE {_CITY_SQL} END"
    return _lines(events, F.expr(
        f"CASE WHEN event_type = 'error' THEN {_ERROR_SQL} WHEN event_type = 'view' THEN {_PAGE_SQL} "
        f"ELSE {_startup_sql(city)} END"), keep)


def csv_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(event_id, ts, *keep, value): `user_id,event_type,event_id,value_in_cents` lines."""
    return _lines(events, F.expr(
        "concat_ws(',', cast(user_id AS STRING), event_type, cast(event_id AS STRING), "
        "cast(cast(floor(value * 100) AS BIGINT) AS STRING))"), keep)


def _lines(events: DataFrame, value: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    # the encoded line is computed once per row even when later filters test it
    return with_columns_once(events, value=value).select("event_id", "ts", *keep, "value")
