"""Connected components of a graph given as a table of links, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Alternates two contractions until the links are stars: every node's larger neighbours are tied to
    its smallest neighbour, then every node and its smaller neighbours to the smallest of them.  The
    minima are combined before the shuffle, the joins are equi-joins that adaptive execution can split
    at a hub; each round is stored, so a lost executor costs one round.
    """
    links = scratch.materialize(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = scratch.materialize(large, "links")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        small = scratch.materialize(small.select("e.*").filter("a != b").distinct(), "links")
        # Stars are left when no node has two smaller neighbours, or one and a larger one.
        ends = small.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            small.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not degrees.filter("up > 1 OR (up = 1 AND down = 1)").limit(1).count():
            break
        links = small
    roots = small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
