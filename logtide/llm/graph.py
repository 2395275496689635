"""Connected components of an edge table, as Spark joins (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b): join larger (or smaller) neighbours to the least one."""
    flip = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(flip) if large else edges.select(F.greatest("a", "b").alias("a"),
                                                                 F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    if large:
        new = around.join(least, "a").where("b > a").select("b", "low")
    else:
        new = around.join(least, "a").select("b", "low").union(least.select("a", "low"))
    return new.toDF("a", "b").where("a <> b").distinct()


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root) of every node of `edges` (a, b); root is the least node of its component.

    Every round is written to the shared folder. Ends when a round changes nothing."""
    spark = edges.sparkSession
    now = written(spark, edges.select("a", "b").where("a <> b").distinct(), name)
    seen = None
    for _ in range(MAX_ROUNDS):
        now = written(spark, _star(_star(now, True), False), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(now.select("b", "b").distinct())
        seen = tuple(state)
    raise RuntimeError("components did not settle")
