"""Connected components of a link table, without ever gathering links on the driver.

Alternating large-star / small-star rounds. Every round is two shuffles on node ids; a hub's neighbours are folded by
``min`` with map-side combining, never collected. Each round is written to the shared checkpoint folder, so lineage
stays short and lost executors only cost the running round.

Defined results: null ends and self links are ignored, repeated links count once, an empty table gives no rows; every
node that occurs in a link gets the smallest id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolodar.runtime import cut


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every leaf (``a``) has one centre (``b``) and no centre is a leaf."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(edges.select("b", F.lit(0), F.lit(1)))
    roles = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return roles.where("leaf > 1 or (leaf = 1 and centre = 1)").isEmpty()


def connected_components(links: DataFrame, left: str, right: str, max_rounds: int = 40) -> DataFrame:
    """node, component (smallest node id reached). Ends as soon as the links form stars; the number of rounds grows with
    the logarithm of a component's size, so more than ``max_rounds`` mean an error and are refused, never cut off."""
    edges = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null and a <> b")
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if _is_star_forest(edges):
            break
        # Large star: every larger neighbour links to the smallest node known to the centre.
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: smaller neighbours and the centre link to the smallest neighbour.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "m").union(low.select(F.col("a").alias("x"), "m"))
        edges = cut(small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b"), F.col("b")).distinct()).toDF("node", "component")
