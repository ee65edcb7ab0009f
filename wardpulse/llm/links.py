"""Connected components of a link table by alternating large and small stars.

Every round is two aggregations and joins over the link table; the table is
landed in the shared folder after each, so lineage stays short, and no group of
neighbours is ever gathered in one task (minima combine map-side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the least node reachable.

    Null ends and self links are ignored. An empty table gives an empty table.
    """
    e = (links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("v") != F.col("m"))).distinct())
    e = land(e, "links")
    state = None
    while True:
        both = e.unionAll(e.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("root"))
        # large star: a node's larger neighbours (and itself) go to its least neighbour
        large = (both.withColumnRenamed("m", "n").join(least, "v").where(F.col("n") > F.col("v"))
                 .select(F.col("n").alias("v"), F.col("root").alias("m"))
                 .where(F.col("v") != F.col("m")).distinct())
        large = land(large, "large")
        # small star: a node and its smaller neighbours go to the least of them
        low = large.groupBy("v").agg(F.min("m").alias("root"))
        small = (large.join(low, "v").select(F.col("m").alias("v"), F.col("root").alias("m"))
                 .unionAll(low.select("v", F.col("root").alias("m")))
                 .where(F.col("v") != F.col("m")).distinct())
        e = land(small, "small")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first())
        if now == state:
            roots = e.select("m").distinct().select(F.col("m").alias("node"), F.col("m").alias("root"))
            return e.select(F.col("v").alias("node"), F.col("m").alias("root")).unionAll(roots)
        state = now
