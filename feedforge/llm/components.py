"""Connected components of a link table by alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): every
round hangs larger neighbours on a node's smallest neighbour, until nothing
moves. Only equality joins and map-side aggregates; every round is written to
the shared work folder, so the plan stays short and a lost executor costs tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _starred(links: DataFrame, larger: bool) -> DataFrame:
    """Large star: hang larger neighbours on the smallest one; else small star."""
    if larger:
        near = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("least"))
    # Read from files, so that the join can split a node with very many links.
    least = stored(least.withColumn("least", F.least("u", "least")), "least")
    joined = near.join(least, "u")
    moved = joined.where("v > u" if larger else "v <> least").select(
        F.col("v").alias("u"), F.col("least").alias("v"))
    if not larger:
        moved = moved.union(least.select("u", F.col("least").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every linked node.

    ``links`` has the columns u and v; direction, repeats and loops don't matter.
    """
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                              F.least("u", "v").alias("v")).distinct(), "links")
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = None
    while (mark := digest(now)) != before:
        before = mark
        now = stored(_starred(stored(_starred(now, True), "large-star"), False), "small-star")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
