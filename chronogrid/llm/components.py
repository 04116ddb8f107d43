"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, spread_join, stage


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("CAST(pmod(xxhash64(b, a), 1000003) AS LONG)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge; root is the smallest node reachable.

    ``edges`` has long columns a and b.  Each step is two grouped minima and a join, stored before the
    next one reads it, until nothing changes; edges of one step are never more than those of the step before
    and their nodes.  The edges of a star's centre are dealt over many tasks.
    """
    spark = edges.sparkSession
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(now)
    if not seen[0]:
        return spark.createDataFrame([], "node long, root long")
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = spread_join(both.where("b > a"), least, ["a"], 2 * seen[0]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select("a", "b", "m")
        then = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        before, now = now, stage(then, "edges")
        drop(before)
        after = _state(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
