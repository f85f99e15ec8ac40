"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wordsieve.session import stored


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """The distinct links in a written table, and their number and a sum that tells them, taken from the write."""
    seen = Observation()
    told = links.where("u <> v").distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark"))
    table = stored(told, "links")
    return table, seen.get


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of the links, root being the smallest node of its component.

    Each round writes its links to the shared folder. A node's neighbours are never gathered: their minimum is
    an aggregate that is written and joined back, so that a hub may have any number of them: joins of written
    tables are broadcast by their size, or have their hot keys split.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges, now = _written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    mark = None
    while now != mark:
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-lowest")
        # Large star: every larger neighbour of a node is linked to the smallest of the node and its neighbours.
        large = stored(both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "links-large")
        # Small star: every smaller neighbour, and the node, is linked to the smallest of them.
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-lowest")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
        edges, now = _written(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")))
    roots = edges.select(F.col("v")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
