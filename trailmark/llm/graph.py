"""Connected components of an edge list that no single task or the driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself: ``u, m``."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``, long); ``root`` is the smallest node reachable.

    Alternating large-star and small-star steps: every step hangs a node's neighbours on the smallest one, so paths halve
    and the edges never become more than they were. A node with very many edges is counted by partial minima and split by
    the skew join; each step is written to the shared folder. No edges give no rows.
    """
    stars = materialize(edges.where("u <> v").select("u", "v").distinct(), name)
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        down = materialize(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), name)
        found = down.join(_nearest(down), "u")
        small = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        stars = materialize(small.where("u <> v").distinct(), name)
        after = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.sum(F.hash("u", "v"))).first())
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
