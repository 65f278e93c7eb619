"""Connected components by alternating star steps, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.llm.common import Stages

#: Star steps after which a run is taken to be broken (each about halves paths).
MAX_STEPS = 100


def connected_components(links: DataFrame, stages: Stages) -> DataFrame:
    """``node, root`` (least node of its component, itself excluded) for links
    ``a, b`` of longs, as a written table.

    A step hangs every larger neighbour, then every smaller one, on a node's
    least neighbour.  Both are a minimum by node (combined before the shuffle)
    joined back to the links, so a node with any number of links is an ordinary
    skewed join; links are written between steps.
    """
    edges = links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u < v").distinct()
    edges, seen = stages.write(edges, "links-0"), None
    for k in range(1, MAX_STEPS):
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.least("x", "m").alias("u"), F.col("y").alias("v")).distinct()
        large = stages.write(large, f"large-{k}")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        near = large.join(least, "v")
        small = least.select(F.col("m").alias("u"), "v").union(near.filter("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))).distinct()
        edges = stages.write(small, f"links-{k}")
        stages.drop(f"links-{k - 1}", f"large-{k}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            out = stages.write(edges.select(F.col("v").alias("node"), F.col("u").alias("root")), "roots")
            stages.drop(f"links-{k}")
            return out
        seen = now
    raise RuntimeError("components did not settle")
