"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every node of the undirected edges (u, v): the smallest node that it is connected with.

    u and v may be of any one type with an order.  Nodes without an edge to
    another node are left out.  Every round hangs neighbours on the smallest
    node around; the number of rounds grows with the logarithm of the nodes.
    Rounds are cut with checkpoint(); the driver sees two numbers of each.
    """
    now = edges.select("u", "v").filter("u <> v").distinct().checkpoint()
    state = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = small.filter("u <> v").distinct().checkpoint()
        # The same edges twice: every node hangs on its component's smallest one.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select("u", F.col("v").alias("root")).union(now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
        state = seen
