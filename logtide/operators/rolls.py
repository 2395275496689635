"""The archive's roll rule: a file takes the first message that comes at least 60 s after the file before it began.

A file begins with a message, so where it begins depends on where the one before began: a chain through all messages
in time order, not a bucket of each message's own time. It is followed in parallel:

* only distinct times matter, so a moment that a third of the messages share is one row;
* after a silence of `roll` or more the next message begins a file whatever came before, which cuts the chain;
* each time points to the first time at least `roll` later, found within coarse buckets of time (a bucket of an hour
  has 3.6 million different milliseconds at most, however many messages it has; an empty rest of a bucket points to
  the next bucket's first time);
* pointer doubling joins the pointers with themselves: after k rounds a time knows the file 2^k files on, until every
  pointer has run out of its silence-free stretch. Followed back from the longest to the shortest jump from all cuts
  at once, they name every file's first message. The rounds grow with the logarithm of the files in the longest
  stretch, and every join is on distinct times, so no key is hot.

Times are epoch milliseconds. Messages without a time belong to no file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.functions.dates import archive_path, from_ms
from logtide.session import scratch_path

ROLL_MS = 60_000                 # Fixed value: the reference's roll period.
BUCKET_MS = 3_600_000
MOST_ROUNDS = 62                 # 2^62 files


def _kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder: every round starts from files, not from all rounds before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _nearest(keys: DataFrame, times: DataFrame, at: str, out: str, after: bool) -> DataFrame:
    """`keys` plus `out`: the first of `times` (column t) not before `at`, or the last one not after it.

    Both are laid out in buckets of time; a window looks within the bucket, and where that holds none the nearest
    bucket that holds one answers from a table with one row a bucket."""
    def bucket(c):
        return F.floor(F.col(c) / BUCKET_MS)

    both = (keys.withColumns({"_at": F.col(at), "_b": bucket(at), "_t": F.lit(None).cast("bigint")})
            .unionByName(times.select(F.col("t").alias("_at"), bucket("t").alias("_b"), F.col("t").alias("_t")),
                         allowMissingColumns=True)
            .withColumn("_key", F.col("_t").isNull()))
    # at equal times a time counts as not before and not after the key
    order = [F.col("_at").desc(), F.col("_key")] if after else [F.col("_at"), F.col("_key")]
    within = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn(out, F.last("_t", ignorenulls=True).over(within)).where("_key")
    ends = times.groupBy(bucket("t").alias("_b")).agg((F.min("t") if after else F.max("t")).alias("_end"))
    # every bucket that a key or a time is in, with the nearest time beyond it: one row a bucket
    buckets = (inside.select("_b").unionByName(ends.select("_b")).distinct().join(ends, "_b", "left")
               .withColumn("_next", F.last("_end", ignorenulls=True).over(
                   Window.orderBy(F.col("_b").desc() if after else F.col("_b")).rowsBetween(Window.unboundedPreceding, -1))))
    return (inside.join(buckets.select("_b", "_next"), "_b", "left")
            .withColumn(out, F.coalesce(out, "_next")).drop("_at", "_b", "_t", "_key", "_next"))


def roll_starts(times: DataFrame, roll_ms: int = ROLL_MS) -> DataFrame:
    """(t): the first message time of every file, from the distinct message times (t, epoch ms)."""
    after = _nearest(times.withColumn("_due", F.col("t") + roll_ms), times, "_due", "next", after=True)
    before = _nearest(times.withColumn("_prev", F.col("t") - 1), times, "_prev", "last", after=False)
    points = after.select("t", "next").join(before.select("t", "last"), "t")
    cut = F.col("last").isNull() | (F.col("t") - F.col("last") >= roll_ms)
    points = _kept(points.select("t", "next", cut.alias("cut")), "roll-points")
    cuts = points.where("cut").select("t")
    # a jump that lands on a cut is not needed: cuts begin files anyway
    jump = _kept(points.where("next IS NOT NULL").select("t", "next")
                 .join(cuts.withColumnRenamed("t", "next"), "next", "left_anti"), "roll-jump")
    jumps = [jump]
    while len(jumps) < MOST_ROUNDS:
        on = jump.select(F.col("t").alias("next"), F.col("next").alias("further"))
        jump = _kept(jump.join(on, "next").select("t", F.col("further").alias("next")), "roll-jump")
        if jump.isEmpty():
            break
        jumps.append(jump)
    starts = cuts
    for jump in reversed(jumps):
        reached = starts.join(jump, "t").select(F.col("next").alias("t"))
        starts = _kept(starts.unionByName(reached), "roll-starts")
    return starts


def archive_rolls(messages: DataFrame, ts_col: str = "timestamp", roll_ms: int = ROLL_MS) -> DataFrame:
    """(path, begins_ms, ends_ms, n_lines) of every file the archiver writes; `path` is named after its first message."""
    counts = _kept(messages.where(F.col(ts_col).isNotNull()).groupBy(F.unix_millis(ts_col).alias("t"))
                   .agg(F.count(F.lit(1)).alias("n")), "roll-times")
    starts = roll_starts(counts.select("t"), roll_ms)
    placed = _nearest(counts, starts, "t", "begins_ms", after=False)
    return (placed.groupBy("begins_ms").agg(F.max("t").alias("ends_ms"), F.sum("n").alias("n_lines"))
            .select(archive_path(from_ms("begins_ms")).alias("path"), "begins_ms", "ends_ms", "n_lines"))
