"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Every step is a grouped minimum (combined before the shuffle) and a join on the node; only the edge
list is moved, no adjacency list is ever gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecheck.llm.common import drop_stored, made, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.  Self-loops and repeated
    edges are allowed; an edge with a NULL end is ignored; no edges give no rows."""
    e = stored(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
               .where("u is not null and v is not null and u <> v")
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    spark, last = e.sparkSession, None
    while True:
        at = made()
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))))
        e = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "edges")
        drop_stored(spark, at - 1, keep=1)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == last:
            break
        last = now
    nodes = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.union(roots)
