"""Record schemas of the three app-log kinds and the envelope of a message.

The three beans share userId/appId/appPlatform. Time is epoch milliseconds.
For parsing we use one *wide* struct holding every field of every kind, so a
line is decoded once whatever its kind; numeric fields are read as STRING and
converted with `try_cast` afterwards (from_json would null a quoted number in
a BIGINT field, whereas the reference's JSON mapper coerces it).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The marker substrings that decide a line's kind, in the
# order the reference's filter tests them.
STARTUP_MARKER = "appVersion"
ERROR_MARKER = "errorMajor"
PAGE_MARKER = "currentPage"

BASE_FIELDS = [
    T.StructField("userId", T.StringType()),
    T.StructField("appId", T.StringType()),
    T.StructField("appPlatform", T.StringType()),
]

STARTUP_SCHEMA = T.StructType(BASE_FIELDS + [
    T.StructField("appVersion", T.StringType()),
    T.StructField("startTimeInMs", T.LongType()),
    T.StructField("activeTimeInMs", T.LongType()),
    T.StructField("city", T.StringType()),
])

PAGE_SCHEMA = T.StructType(BASE_FIELDS + [
    T.StructField("pageViewCntInSession", T.IntegerType()),
    T.StructField("currentPage", T.StringType()),
    T.StructField("pageVisitIndex", T.IntegerType()),
    T.StructField("nextPage", T.StringType()),
    T.StructField("stayDurationInSecs", T.LongType()),
    T.StructField("createTimeInMs", T.LongType()),
])

ERROR_SCHEMA = T.StructType(BASE_FIELDS + [
    T.StructField("errorMajor", T.StringType()),
    T.StructField("errorInDetail", T.StringType()),
    T.StructField("createTimeInMs", T.LongType()),
])

# Numeric fields of the beans: name -> target type. Parsed as text first.
NUMERIC_FIELDS = {
    "startTimeInMs": T.LongType(),
    "activeTimeInMs": T.LongType(),
    "pageViewCntInSession": T.IntegerType(),
    "pageVisitIndex": T.IntegerType(),
    "stayDurationInSecs": T.LongType(),
    "createTimeInMs": T.LongType(),
}

# Page-visit numbers are primitives / initialised to 0 in the bean, so a
# missing value reads as 0 there; startup/error times stay null.
PAGE_DEFAULT_ZERO = ("pageViewCntInSession", "pageVisitIndex", "stayDurationInSecs", "createTimeInMs")


def _wide_parse_schema() -> T.StructType:
    seen: dict[str, T.StructField] = {}
    for schema in (STARTUP_SCHEMA, PAGE_SCHEMA, ERROR_SCHEMA):
        for field in schema.fields:
            if field.name not in seen:
                dtype = T.StringType() if field.name in NUMERIC_FIELDS else field.dataType
                seen[field.name] = T.StructField(field.name, dtype)
    return T.StructType(list(seen.values()) + [T.StructField("_corrupt_record", T.StringType())])


WIDE_PARSE_SCHEMA = _wide_parse_schema()

# Kafka-shaped message envelope (what `readStream.format("kafka")` yields,
# with key/value already cast to text).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
