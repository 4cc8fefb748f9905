"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenocast.llm._common import few, written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of ``links`` with the smallest node reachable.

    Large-star joins each node's larger neighbours to its smallest neighbour,
    small-star does so with its smaller ones, until nothing changes; a chain of n
    nodes takes O(log^2 n) rounds.  Minima are combined before the shuffle, a hub
    is split by adaptive execution where it is joined, and each round is a
    written table, so no lineage builds up and nothing is held on the driver.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u <> v").distinct(), "cc-links")
    total = 2 * edges.count()
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = written(few(large, total), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        small = written(few(small, total), "cc-small")
        # a forest of stars: nobody who points at a root is pointed at, and each node points once
        loose = (small.groupBy("u").count().where("count > 1").select("u").limit(1)
                 .unionAll(small.select("v").join(small.select(F.col("u").alias("v")), "v", "left_semi").limit(1)))
        edges = small
        if loose.isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
