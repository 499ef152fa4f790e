"""Connected components of a table of links, by star contraction.

Each round turns the links towards the smallest neighbour and links the rest to
it, until every node hangs on the smallest node of its component. Rounds grow
with the logarithm of the longest path. A node with very many links is shuffled
as partial minima and joined, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.sources.staging import stage, stage_counted


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b), root being the least node it reaches.

    Two smaller nodes of one node are linked with each other through its smallest
    one; a round that changes nothing ends the work. No links give no rows.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    links = links.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    links, count = stage_counted(links, "links")
    before = None
    while count:
        # Small star: the smaller neighbours of a node, and the node, hang on the smallest one.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        hung = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), "m")
        small = least.select("a", "m").unionByName(hung).distinct()
        # Large star: the larger neighbours of a node hang on its smallest neighbour or itself.
        both = small.select("a", F.col("m").alias("b"))
        around = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = around.groupBy("a").agg(F.min("b").alias("m"))
        nearest = nearest.select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(nearest, "a")
        links = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        links, count = stage_counted(links, "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
