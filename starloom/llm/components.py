"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each step re-hangs a node's
neighbours on its smallest one. Only the links move, each step is cut with a
reliable checkpoint, and the number of steps grows with the logarithm of the
longest chain. A node with very many neighbours is summed by partial
aggregates; the join that follows is an ordinary one whose large partitions
Spark's skew handling splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v) with u > v. One large-star or small-star step."""
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = links.groupBy("u").agg(F.min("v").alias("m"))
        hung = links.join(low, "u")
        out = hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): each linked node with its smallest reachable node.

    Nodes without a link to another node are not in the result. Repeated
    links, links to oneself, links in either direction and links with a null
    end are all allowed (the last two kinds of no-link are left out); an empty
    table gives an empty result.
    """
    a, b = F.col("a"), F.col("b")
    links = checkpoint(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = state(links)
    while seen[0]:
        links = checkpoint(_star(_star(links, large=True), large=False))
        now = state(links)
        if now == seen:
            break
        seen = now
    # now every link is (node, smallest node)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
