"""Connected components by alternating large-star and small-star steps.

Each step is two grouped minima and two joins; stars shrink the graph's
diameter by a factor per round, so the rounds grow with its logarithm.  The
edges of a round are a table in the shared folder.  Nothing but a row count
and a checksum comes to the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairflow.llm.base import saved


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: (u, v) long, any direction, repeats and loops allowed.
    Returns (node, component): the smallest node reachable, for every node that
    has an edge to another and is not itself the smallest."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = saved(e)
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
