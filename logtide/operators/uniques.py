"""Unique users per hour with mergeable HyperLogLog sketches, and key retention.

The reference adds each user id to a per-hour HyperLogLog in an external store
and renews a one-day expiry on every add. Here:

* `user_hours`     CSV message -> (hour_key, user_id, timestamp); the hour comes
                   from the message timestamp (replayable) or, optionally, from
                   processing time as in the reference.
* `hourly_sketches` one `hll_sketch_agg(user_id, 14)` per hour, with the hour's
                   last write time. 2^14 registers is the dense size of the
                   reference store's sketch (std. error about 0.81 %). Sketches
                   are built per input partition and merged after the shuffle,
                   so a hot hour moves one sketch per partition, not its rows.
* `sketch_estimates`, `merge_sketches` read or union sketch tables (hours into
                   days, or the per-batch deltas of a stream into totals).
* `retained`       keys whose last write is less than `ttl` before `as_of`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.dates import hour_key
from logtide.functions.logs import csv_field

HLL_LG_K = 14
# Bound used by the approximate queries' self-check.
HLL_CHECK_REL = 0.03


def user_hours(messages: DataFrame, line_col: str = "value", ts_col: str = "timestamp",
               processing_time: bool = False, keep: list[str] = ()) -> DataFrame:
    """(hour_key, user_id, write_ts, *keep) from CSV messages; hour from the message or the wall clock."""
    ts = F.current_timestamp() if processing_time else F.col(ts_col)
    return messages.select(hour_key(ts).alias("hour_key"),
                           csv_field(line_col, 0).alias("user_id"),
                           ts.alias("write_ts"), *keep)


def hourly_sketches(uh: DataFrame, lg_k: int = HLL_LG_K, by: list[str] = (), extra: list[Column] = ()) -> DataFrame:
    """(hour_key, *by, sketch, last_write, n_rows, *extra)."""
    return uh.groupBy("hour_key", *by).agg(
        F.hll_sketch_agg("user_id", lg_k).alias("sketch"),
        F.max("write_ts").alias("last_write"),
        F.count(F.lit(1)).alias("n_rows"), *extra)


def merge_sketches(sketches: DataFrame, key: Column | str, name: str | None = None) -> DataFrame:
    """Union sketches per key: (key, sketch, last_write, n_rows)."""
    k = key if isinstance(key, Column) else F.col(key)
    return sketches.groupBy(k.alias(name) if name else k).agg(
        F.hll_union_agg("sketch", True).alias("sketch"),
        F.max("last_write").alias("last_write"),
        F.sum("n_rows").alias("n_rows"))


def sketch_estimates(sketches: DataFrame, key: str = "hour_key") -> DataFrame:
    """(key, uv_est, last_write) from a sketch table."""
    return sketches.select(key, F.hll_sketch_estimate("sketch").alias("uv_est"), "last_write")


def retained(sketches: DataFrame, as_of: Column | None = None, ttl: str = "1 day") -> DataFrame:
    """Keys still alive at `as_of` (default: now): last_write + ttl > as_of."""
    now = as_of if as_of is not None else F.current_timestamp()
    return sketches.where(F.col("last_write") + F.expr(f"INTERVAL {ttl}") > now)


def within_bound(estimate: Column, exact: Column, rel: float = HLL_CHECK_REL) -> Column:
    """|estimate - exact| <= max(1, rel * exact)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(rel))


def distinct_users(uh: DataFrame, key: Column | str = "hour_key", name: str = "hour_key") -> DataFrame:
    """(name, user_id, write_ts) with one row per key and user.

    The dedupe shuffles on (key, user) after a map-side partial dedupe, so a
    hot key spreads over its users instead of landing in one task. Exact and
    approximate distinct counts can then both be plain aggregates over it (an
    HLL ignores duplicates, so estimates are unchanged).
    """
    k = key if isinstance(key, Column) else F.col(key)
    return uh.groupBy(k.alias(name), "user_id").agg(F.max("write_ts").alias("write_ts"))


def daily_key(hour_key_col: str = "hour_key") -> Column:
    """yyyyMMdd of an hour key yyyyMMdd-HH."""
    return F.substring(F.col(hour_key_col), 1, 8)
