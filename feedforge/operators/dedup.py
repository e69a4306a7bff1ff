"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: str = "ingested_at",
                 tie_break: Sequence[str] = (), desc: bool = True) -> DataFrame:
    """Latest (or earliest) row per key.

    The ``row_number() = 1`` shape lets Spark keep only the best row per key in
    every map task before the shuffle, so many copies of one key cost no more
    than one row per task. Without a tie-break a hash over the row decides, so
    that a recomputed task picks the same row again.
    """
    primary = F.col(order_by).desc() if desc else F.col(order_by).asc()
    if tie_break:
        rest = [F.col(c).desc() if desc else F.col(c).asc() for c in tie_break]
    else:
        rest = [F.xxhash64(*[F.col(c) for c in df.columns])]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(primary, *rest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
