"""Column functions over raw log lines: kind markers, CSV fields, JSON decode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logtide.schemas import ERROR_MARKER, PAGE_MARKER, STARTUP_MARKER, WIDE_PARSE_SCHEMA

# Fixed value: the reference splits comma-separated lines into at most 46 parts.
CSV_SPLIT_LIMIT = 46


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def has_log_marker(line="value") -> Column:
    """The type filter: the line mentions appVersion, errorMajor or currentPage
    (case-sensitive substring anywhere in the line)."""
    if isinstance(line, str):
        return F.expr(" OR ".join(f"contains(`{line}`, '{m}')" for m in (STARTUP_MARKER, ERROR_MARKER, PAGE_MARKER)))
    return (F.contains(line, F.lit(STARTUP_MARKER)) | F.contains(line, F.lit(ERROR_MARKER))
            | F.contains(line, F.lit(PAGE_MARKER)))


def log_kind(line="value") -> Column:
    """'startup' | 'error' | 'page' by marker (startup wins, as in the validation
    rule); null for lines with no marker."""
    v = _col(line)
    return (F.when(F.contains(v, F.lit(STARTUP_MARKER)), F.lit("startup"))
            .when(F.contains(v, F.lit(ERROR_MARKER)), F.lit("error"))
            .when(F.contains(v, F.lit(PAGE_MARKER)), F.lit("page")))


def mentions(line, text: str) -> Column:
    """Substring test (the city filter uses text='city')."""
    return F.contains(_col(line), F.lit(text))


def csv_field(line="value", index: int = 0, limit: int = CSV_SPLIT_LIMIT) -> Column:
    """Field `index` of a comma-separated line split into at most `limit` parts.
    Trailing empty fields are kept; an index past the end gives null."""
    return F.get(F.split(_col(line), ",", limit), index)


def decode_json(line="value", fields: tuple[str, ...] | None = None) -> Column:
    """One-pass decode of any log kind into the wide struct, or into `fields` of it
    (PERMISSIVE mode: malformed text gives a struct whose `_corrupt_record` holds the line)."""
    schema = WIDE_PARSE_SCHEMA if fields is None else StructType(
        [f for f in WIDE_PARSE_SCHEMA.fields if f.name in fields or f.name == "_corrupt_record"])
    return F.from_json(_col(line), schema, {"mode": "PERMISSIVE"})
