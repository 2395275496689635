"""Column functions (all Catalyst expressions, no Python UDFs)."""

from logtide.functions.dates import (  # noqa: F401
    DEFAULT_PATTERN, archive_path, date_to_string, day_begin, day_begin_str, day_begin_ts, format_time,
    format_time_str, format_week_begin, hour_key, in_day, in_month, in_week, month_begin, month_begin_str,
    month_begin_ts, parse_time, register_sql_functions, week_begin, week_begin_str, week_begin_ts)
from logtide.functions.logs import csv_field, decode_json, has_log_marker, log_kind, mentions  # noqa: F401
