"""Connected components of a link table, by alternating star contraction.

Each round is two groupings by node and two joins, all on tables of links; the labels are never
collected. A node with very many links is folded by a partial minimum before the shuffle, and its
side of the join is one that adaptive execution may split. Stars (all links to the smallest node)
are the fixed point; a group that arrives as a star needs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailstat.llm.tables import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Links of a node with itself and links with a null end count for nothing; no links give no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    seen = None
    while True:
        total = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(total) == seen or not total[0]:
            break
        seen = tuple(total)
        edges = stored(_small_star(_large_star(edges)), "links")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
