"""Position of every row within its group, without a task that holds a group.

A window over a group puts the whole group into one task. Here the rows are
dealt by ranges of (group, order), so a large group covers many partitions, and
a row's position is its place within the partition plus the rows of its group in
earlier partitions. Only a partition's first group can have begun earlier, so
there are no more such corrections than partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import ship, stored


def ranked(df: DataFrame, group: str, order: list[str | Column]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``part`` and ``rank``, spans of the groups).

    ``rank`` counts from 0 in the given order; rows that tie in all of it may be
    exchanged for one another, and are split over partitions like others. A null
    group is a group. ``spans`` has a row per group and partition: (group, part,
    n, before), where ``before`` counts the group's rows in earlier partitions.
    """
    ship(df.sparkSession)
    keys = [F.col(group), *order, F.monotonically_increasing_id()]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(group, *order)
    at = df.columns.index(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = object(), 0
        for batch in batches:
            places = []
            for value in batch.column(at).to_pylist():
                place = place + 1 if value == last else 0
                last = value
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])

    placed = dealt.withColumn("part", F.spark_partition_id())
    rows = stored(placed.mapInArrow(run, T.StructType([*placed.schema, T.StructField("place", T.LongType())])), "placed")
    counts = rows.groupBy(group, "part").agg((F.max("place") + 1).alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "spans")
    moved = spans.where("before > 0").select(F.col(group).alias("_group"), F.col("part").alias("_part"), "before")
    # At most one row a partition, whatever the number of rows.
    joined = rows.join(F.broadcast(moved), rows[group].eqNullSafe(F.col("_group")) & (rows["part"] == F.col("_part")), "left")
    rank = F.col("place") + F.coalesce("before", F.lit(0))
    return joined.select(*df.columns, "part", rank.alias("rank")), spans
