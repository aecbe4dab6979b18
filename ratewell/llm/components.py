"""Connected components of links, by alternating stars written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.staging import stage


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for every end of a link (a, b).

    Each round hooks all neighbours of a node that are larger than it onto its smallest neighbour,
    then does so for the smaller ones.  It ends when every node hangs on one other and those hang on
    none, after a number of rounds that grows with the logarithm of the longest path.  A node with
    very many links is a key whose minimum is combined before the shuffle.  Repeated links, links to
    itself and an empty table are allowed.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        ends = edges.select(F.col("u").alias("node"), "v").union(edges.select(F.col("v").alias("node"), "v"))
        roots = ends.groupBy("node").agg(F.min("v").alias("root"), F.max("v").alias("most"))
        if roots.where("root <> most").isEmpty():
            return roots.select("node", "root")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(hooked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
