"""Depth of comments in a reply tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.sources.workdir import work_dir


def thread_depth(df: DataFrame, scope: Sequence[str], node: str, parent: str,
                 into: str = "recomputed_depth") -> DataFrame:
    """Steps from every comment up to its root, for trees of any depth.

    Pointer jumping over (scope, node, ancestor, steps): each round replaces the
    ancestor by the ancestor's ancestor, so a chain of n comments takes log2 n
    rounds. Only unfinished rows are joined; finished ones are looked up. Rounds
    are written to the work folder, and the depth is joined back once.

    ``<into>_missing`` marks a walk that ends at a comment without a row,
    ``<into>_cycle`` one that never ends; both have a null depth. A node that
    occurs more than once counts as one comment, with its smallest parent; a
    null node has a null depth and neither mark.
    """
    keys = list(scope)
    spark = df.sparkSession
    edges = df.where(F.col(node).isNotNull()).groupBy(*keys, F.col(node).alias("_node")) \
        .agg(F.min(parent).alias("_up"))
    known = edges.select(*keys, F.col("_node").alias("_up"), F.lit(True).alias("_there"))
    walk = edges.join(known, [*keys, "_up"], "left").select(
        *keys, "_node", "_up", F.when(F.col("_up").isNull(), 0).otherwise(1).cast("long").alias("_steps"),
        (F.col("_up").isNotNull() & F.col("_there").isNull()).alias("_missing"))

    def written(rows: DataFrame) -> DataFrame:
        path = work_dir(spark, "thread-walk")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    walk = written(walk)
    total = walk.count()
    rounds, reach = 0, 1
    while reach < 2 * max(total, 1):  # then only cycles are left
        live = F.col("_up").isNotNull() & ~F.col("_missing")
        ahead = walk.select(*keys, F.col("_node").alias("_up"), F.col("_up").alias("_next"),
                            F.col("_steps").alias("_more"), F.col("_missing").alias("_lost"))
        moved = walk.where(live).join(ahead, [*keys, "_up"]).select(
            *keys, "_node", F.col("_next").alias("_up"),
            (F.col("_steps") + F.col("_more")).alias("_steps"), F.col("_lost").alias("_missing"))
        walk = written(moved.union(walk.where(~live).select(*moved.columns)))
        rounds, reach = rounds + 1, reach * 2
        if walk.where(live).isEmpty():
            break
    ended = F.col("_up").isNull() & ~F.col("_missing")
    result = walk.select(
        *[F.col(k).alias(f"_{k}") for k in keys], "_node", F.when(ended, F.col("_steps")).alias(into),
        F.col("_missing").alias(f"{into}_missing"), (~ended & ~F.col("_missing")).alias(f"{into}_cycle"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col(node) == F.col("_node")]
    return df.join(result, on, "left").drop("_node", *[f"_{k}" for k in keys])
