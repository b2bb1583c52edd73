"""Connected components of a table of links, by alternating stars.

Each round links every node's larger neighbours to its smallest one, then its smaller neighbours;
distances shrink by a constant factor, and at the end each node hangs on the smallest of its
component. Only minima are aggregated by node, which combine before they are shuffled; no list of
a node's neighbours is ever gathered. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def components(links: DataFrame) -> DataFrame:
    """``links (a, b)`` to ``(node, root)``: one row for each linked node but the smallest of its component."""
    ends = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(ends.distinct(), "links")
    before, now = None, _fingerprint(edges)
    while now != before and now[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least).distinct(), "links")
        before, now = now, _fingerprint(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
