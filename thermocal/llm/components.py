"""Connected components of an edge table, by large-star / small-star rounds.

Each round is a few joins and aggregates on the edge table, which is stored in the shared
folder after it; nothing is gathered in one place, a node of many edges included (its
rows are aggregated map-side, and its join may be split). Nodes may be of any orderable
type. Ends when the edges are stars around the least node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges`` but the roots; root: the component's least node.

    Edges with a null end, and from a node to itself, are left out.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while not _stars(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo")
                 .union(low.select("hi", F.col("m").alias("lo"))).distinct())
        nxt = stored(small, "edges")
        dropped(e)
        e = nxt
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _stars(e: DataFrame) -> bool:
    """Every node above another has one edge down, to a node without edges down."""
    if e.groupBy("hi").count().filter("count > 1").limit(1).count():
        return False
    tops = e.select(F.col("hi").alias("lo"))
    return not e.join(tops, "lo", "left_semi").limit(1).count()
