"""Connected components of a link table, by alternating large-star and small-star steps.

Each round is two grouped minima and two joins, so no component meets in one task; the
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoflow.llm import common as C


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; a component is named by its least node.

    Links of a node with itself and links with a null are ignored.
    """
    edges = C.cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v and u is not null and v is not null")
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .distinct()
    )
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = C.cut(
            small.union(down.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        )
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a lesser one, and those have none."""
    lesser, greater = edges.select(F.col("v").alias("x")), edges.select(F.col("u").alias("x"))
    twice = edges.groupBy("u").count().where("count > 1")
    return twice.isEmpty() and lesser.join(greater, "x", "left_semi").isEmpty()
