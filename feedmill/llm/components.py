"""Connected components of a link table by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). A node's links are never
gathered in one place: each round takes the least neighbour of every node with a partial aggregate
and joins it back. Both sides of the joins are written tables, so a node with very many links is
split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.scratch import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round over a written table of links a > b."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    met = both.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return written(out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _stars_only(links: DataFrame) -> bool:
    """Whether every node but the centres has one link, to a centre."""
    centres = links.select("b", F.lit(True).alias("centre")).distinct()
    seen = links.groupBy("a").agg(F.count("*").alias("n"))
    return not seen.join(centres, seen["a"] == centres["b"], "left").where("n > 1 or centre").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """Label every node of the links (a, b) with the least node of its component: (node, component).

    Null ends and links of a node to itself are left out; an empty table gives an empty one.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars_only(links):
        links = _star(_star(links, large=True), large=False)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
