"""Rolling windows and top-k reports over pre-aggregated days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_days(daily: DataFrame, keys: Sequence[str], day: str, value: str, days: int,
                 into: str) -> DataFrame:
    """Sum over the last ``days`` calendar days; input has one row per key and day.

    Every row is spread over the days it counts for and summed there, so a key
    keeps its sum on days of its own without a row. Days after the last day of
    the input are left out. ``value`` is that of the day itself, 0 without a row.
    """
    last = daily.agg(F.max(day)).first()[0]
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = daily.select(*keys, day, F.col(value).alias("_v"), ahead.alias("_ahead"))
    return spread.groupBy(*keys, F.date_add(F.col(day), F.col("_ahead")).alias(day)).agg(
        F.sum(F.when(F.col("_ahead") == 0, F.col("_v")).otherwise(0)).alias(value),
        F.sum("_v").alias(into)).where(F.col(day) <= F.lit(last))


def running_total(daily: DataFrame, keys: Sequence[str], day: str, values: dict[str, str]) -> DataFrame:
    """Cumulative sums by day; input has one row per key and day."""
    so_far = Window.partitionBy(*keys).orderBy(day) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumns({new: F.sum(old).over(so_far) for new, old in values.items()})


def top_per_group(df: DataFrame, group: Sequence[str], by: str, k: int, rank: str = "rank",
                  dense: bool = False) -> DataFrame:
    """The ``k`` best ranks of every group, ties included.

    The rank filter is applied inside every map task before the shuffle, so a
    group reaches its final task already cut to its candidates.
    """
    order = Window.partitionBy(*group).orderBy(F.col(by).desc())
    position = F.dense_rank() if dense else F.rank()
    return df.withColumn(rank, position.over(order)).filter(F.col(rank) <= k)
