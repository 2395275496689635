"""Routing and validation of raw log lines (type filter, decode, required fields).

`parse_logs` decodes each line once into the wide struct and adds:

  log_kind       'startup' | 'error' | 'page' (by marker substring) or null
  <bean fields>  userId ... createTimeInMs, numbers converted from JSON text
  malformed      the line has a marker but is not a JSON object
  reject_reason  null when the line passes the reference's filter, else
                 'no_marker' | 'malformed' | 'missing_city' | 'missing_user' | 'missing_app'
                 (only startup lines are checked for fields; page and error
                 lines with a marker pass untouched, as in the reference)

Lines without a marker are never decoded: the decode sits behind the marker
test inside one CASE, so CSV or junk lines cost only the substring scan. The
decode is evaluated once per row (`with_columns_once`), however many field
predicates follow.

Deliberate differences from the reference (see README): a startup line with
no start time is valid but not countable (reason 'missing_time' from
`click_reject_reason`), unknown JSON fields are ignored unless `reject_unknown`
is applied, and a malformed line is rejected instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.logs import decode_json, has_log_marker, log_kind, mentions
from logtide.plans.shaping import with_columns_once
from logtide.schemas import (ERROR_SCHEMA, NUMERIC_FIELDS, PAGE_DEFAULT_ZERO, PAGE_SCHEMA,
                             STARTUP_SCHEMA, WIDE_PARSE_SCHEMA)

_FIELD_NAMES = [f.name for f in WIDE_PARSE_SCHEMA.fields if f.name != "_corrupt_record"]


def keep_log_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Type filter: keep lines mentioning appVersion, errorMajor or currentPage."""
    return lines.where(has_log_marker(line_col))


def keep_city_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """City filter: keep lines mentioning 'city' (applied, unlike the reference)."""
    return lines.where(mentions(line_col, "city"))


def _field_sql(name: str) -> str:
    """SQL text of one decoded field (numbers coerced from JSON text)."""
    raw = f"_j.{name}"
    if name not in NUMERIC_FIELDS:
        return f"{raw} AS {name}"
    sql_type = "BIGINT" if NUMERIC_FIELDS[name].typeName() == "long" else "INT"
    conv = f"coalesce(try_cast({raw} AS {sql_type}), try_cast(try_cast({raw} AS DOUBLE) AS {sql_type}))"
    if name in PAGE_DEFAULT_ZERO:
        conv = f"CASE WHEN log_kind = 'page' THEN coalesce({conv}, CAST(0 AS {sql_type})) ELSE {conv} END"
    return f"{conv} AS {name}"


_MALFORMED_SQL = "({decoded} AND (_j IS NULL OR _j._corrupt_record IS NOT NULL))"


def _reason_sql(malformed: str, fields: tuple[str, ...]) -> str:
    checks = "".join(f"WHEN log_kind = 'startup' AND _j.{name} IS NULL THEN '{reason}' "
                     for name, reason in (("city", "missing_city"), ("userId", "missing_user"), ("appId", "missing_app"))
                     if name in fields)
    return ("CASE WHEN log_kind IS NULL THEN 'no_marker' "
            f"WHEN log_kind = 'startup' AND {malformed} THEN 'malformed' {checks}END AS reject_reason")


def parse_logs(lines: DataFrame, line_col: str = "value", fields: tuple[str, ...] | None = None,
               kinds: tuple[str | None, ...] = ("startup", "error", "page")) -> DataFrame:
    """Decode raw lines once: kind, bean fields, malformed flag and reject reason (see module doc).

    `fields` decodes only these bean fields (required-field reasons cover those
    among them), `kinds` only lines of these kinds (None: lines without a marker);
    the rest of the line or of the lines costs no parsing."""
    names = tuple(_FIELD_NAMES if fields is None else [n for n in _FIELD_NAMES if n in fields])
    kind = log_kind(line_col)
    wanted = kind.isin([k for k in kinds if k is not None])
    wanted = F.coalesce(wanted, F.lit(None in kinds))
    # decode once per row: later filters on fields must not re-run from_json
    decoded = with_columns_once(lines, log_kind=kind,
                                _j=F.when(wanted, decode_json(line_col, None if fields is None else names)))
    listed = ", ".join(f"'{k}'" for k in kinds if k is not None)
    malformed = _MALFORMED_SQL.format(
        decoded=f"(coalesce(log_kind IN ({listed}), {str(None in kinds).lower()}))")
    keep = [f"`{c}`" for c in lines.columns]
    return decoded.selectExpr(*keep, "log_kind", *[_field_sql(n) for n in names], f"{malformed} AS malformed",
                              _reason_sql(malformed, names))


def unknown_fields(line_col: str = "value") -> Column:
    """Names in a line's JSON object that the bean of its kind has no field for; null where the line is no object.

    The line is parsed once, as a VARIANT, and its names are compared with the bean's as sets."""
    def bean(schema):
        return F.array(*[F.lit(f.name) for f in schema.fields])

    names = F.map_keys(F.try_parse_json(line_col).try_cast("map<string, variant>"))
    known = (F.when(log_kind(line_col) == "error", bean(ERROR_SCHEMA)).when(log_kind(line_col) == "page", bean(PAGE_SCHEMA))
             .otherwise(bean(STARTUP_SCHEMA)))
    return F.array_except(names, known)


def reject_unknown(parsed: DataFrame, line_col: str = "value") -> DataFrame:
    """Strict decoding: `parse_logs` output with reason 'unknown_field' for lines with fields their bean lacks.

    That is what the reference's JSON mapper does by default. It reads the bean before it validates, so an unknown
    field comes before a missing one, and it holds for page and error lines too."""
    strange = F.col("log_kind").isNotNull() & ~F.col("malformed") & (F.size(unknown_fields(line_col)) > 0)
    return parsed.withColumn("reject_reason", F.when(strange, "unknown_field").otherwise(F.col("reject_reason")))


def keep_valid(parsed: DataFrame) -> DataFrame:
    """Required-field validation (the reference's filter, after parse_logs)."""
    return parsed.where(F.col("reject_reason").isNull())


def click_reject_reason(parsed: DataFrame) -> DataFrame:
    """Adds `click_reason`: null when the row can be counted as a click."""
    reason = F.coalesce(
        F.col("reject_reason"),
        F.when(F.col("log_kind") != "startup", F.lit("not_startup")),
        F.when(F.col("startTimeInMs").isNull(), F.lit("missing_time")))
    return parsed.withColumn("click_reason", reason)


def _typed(parsed: DataFrame, kind: str, schema, extra=()) -> DataFrame:
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return parsed.where((F.col("log_kind") == kind) & F.col("reject_reason").isNull() & ~F.col("malformed")) \
        .select(*extra, *cols)


def startup_logs(parsed: DataFrame, extra=()) -> DataFrame:
    """Typed view of valid startup logs, plus `start_ts` (TIMESTAMP)."""
    return _typed(parsed, "startup", STARTUP_SCHEMA, extra) \
        .withColumn("start_ts", F.timestamp_millis("startTimeInMs"))


def page_logs(parsed: DataFrame, extra=()) -> DataFrame:
    """Typed view of page-visit logs."""
    return _typed(parsed, "page", PAGE_SCHEMA, extra)


def error_logs(parsed: DataFrame, extra=()) -> DataFrame:
    """Typed view of error logs."""
    return _typed(parsed, "error", ERROR_SCHEMA, extra)


def rejected_logs(parsed: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines that fail the filter or cannot be counted, with their reason."""
    with_reason = click_reject_reason(parsed)
    reason = F.coalesce(F.col("reject_reason"),
                        F.when(F.col("malformed"), F.lit("malformed")),
                        F.when(F.col("log_kind") == "startup", F.col("click_reason")))
    return with_reason.where(reason.isNotNull()).select(line_col, "log_kind", reason.alias("reason"))


def route_counts(parsed: DataFrame) -> DataFrame:
    """(log_kind, n) over lines that pass the type filter."""
    return parsed.where(F.col("log_kind").isNotNull()).groupBy("log_kind").agg(F.count(F.lit(1)).alias("n"))
