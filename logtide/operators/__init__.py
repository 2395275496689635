"""Table-level operators: routing/validation, counters, unique users, offsets, archive."""

from logtide.operators.counters import CITY_DATE, DATE_CITY, city_click_counts, click_events, clicks_by  # noqa: F401
from logtide.operators.offsets import (  # noqa: F401
    admitted_ranges, committed, ledger_ranges, offset_ranges, ranges_json, start_offsets, start_offsets_json)
from logtide.operators.routing import (  # noqa: F401
    error_logs, keep_city_lines, keep_log_lines, keep_valid, page_logs, parse_logs, rejected_logs, route_counts,
    startup_logs)
from logtide.operators.uniques import (  # noqa: F401
    distinct_users, hourly_sketches, merge_sketches, retained, sketch_estimates, user_hours)
