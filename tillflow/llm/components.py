"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node of `links` (a, b: longs).

    Large star and small star in turn: every node hangs its neighbours on the
    smallest node it knows, until nothing moves. Minima are folded map-side and the
    joins are by node, so a node with very many links is split like any hot key.
    """
    edges = stored(_between(links), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(smallest, "a").filter("b > a").select("b", F.least("a", "m").alias("m"))
        large = stored(_between(large), "links")  # (node, smaller)
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(smallest, "a").filter("b <> m").select("b", "m")
        edges = stored(_between(hung.union(smallest.select("a", "m"))), "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    # All stars now: every node beside its root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _between(pairs: DataFrame) -> DataFrame:
    """Each pair once, as (a, b) with the larger first; none from a node to itself."""
    x, y = pairs.columns
    return (
        pairs.filter(F.col(x) != F.col(y))
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
