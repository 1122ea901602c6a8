"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest id around it to its larger neighbours; edges may repeat."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is a centre or has one edge to a smaller node, which is a centre. Edges have u > v."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("below")), F.struct(F.col("v").alias("node"), F.lit(0).alias("below")))).alias("e"))
    nodes = ends.select("e.*").groupBy("node").agg(F.sum("below").alias("below"), F.count(F.lit(1)).alias("edges"))
    return nodes.filter("below > 1 or (below = 1 and edges > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two bigint columns); the root is the smallest node reachable.

    Each round is a written table; the number of rounds grows with the logarithm of the longest path.
    Hub nodes are combined before the shuffle (minimum) or split by the skew join. Self links count as
    nodes; NULLs are left out.
    """
    a, b = links.columns
    pairs = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = materialize(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    edges = pairs.filter("u <> v")
    while not _are_stars(edges):
        edges = materialize(_small_star(_large_star(edges)), "stars")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
