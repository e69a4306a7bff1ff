"""Event-time operators on streams, and drains that turn them into tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedforge.sources.workdir import work_dir

# How late an event may arrive, and how long after its post an
# engagement may happen.
EVENT_DELAY = "60 seconds"
ENGAGEMENT_WINDOW = "24 hours"
SALTS = 16


def as_instant(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; zone-less timestamps are read as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = EVENT_DELAY,
                 spread: str | None = None, salts: int = SALTS) -> DataFrame:
    """First arrival per key, remembered for the watermark delay.

    ``spread`` names a column that differs between the copies of a key. Copies are
    then first dropped per key and lane of its hash: a key with very many copies is
    thinned out by ``salts`` tasks before one task sees it, for the price of a
    second shuffle and state.
    """
    timed = as_instant(stream, ts).withWatermark(ts, delay)
    if spread:
        lane = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
        timed = timed.withColumn("_lane", lane).dropDuplicatesWithinWatermark([*keys, "_lane"]).drop("_lane")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def stream_daily_counts(stream: DataFrame, keys: Sequence[str], ts: str,
                        delay: str = EVENT_DELAY) -> DataFrame:
    """Counts per key and day, kept up to date; use the update output mode.

    Every task adds its rows up before the state is touched.
    """
    timed = as_instant(stream, ts).withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, "1 day").alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias("n_events")
    ).select(F.to_date("_w.start").alias("day"), *keys, "n_events")


def stream_interval_join(opens: DataFrame, follows: DataFrame, keys: Sequence[str], open_ts: str,
                         follow_ts: str, window: str = ENGAGEMENT_WINDOW, delay: str = EVENT_DELAY,
                         spread: str | None = None, salts: int = SALTS, unanswered: bool = False) -> DataFrame:
    """Pairs where the second event follows the first within ``window``.

    With ``unanswered``, an opening event that nothing followed comes once, with
    nulls for the second, as soon as the watermark has passed its window and
    nothing can follow any more. Both kinds of state go then, so what is kept is
    bounded by the window and the delay.

    ``spread`` names a column of the follow-up events that differs between
    them. Their state is then divided into lanes by its hash and the opening
    events, of which there are few per key, are held in every lane: a post with
    very many engagements is kept by ``salts`` tasks instead of one.
    """
    if spread and unanswered:
        raise ValueError("an opening event is held in several lanes, none of which knows of the others")
    left = as_instant(opens, open_ts).withWatermark(open_ts, delay)
    right = as_instant(follows, follow_ts).withWatermark(follow_ts, delay)
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    if spread:
        left = left.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        right = right.withColumn("_lane", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        on.append(F.col("l._lane") == F.col("r._lane"))
    within = [F.col(f"r.{follow_ts}") > F.col(f"l.{open_ts}"),
              F.col(f"r.{follow_ts}") <= F.col(f"l.{open_ts}") + F.expr(f"INTERVAL {window}")]
    joined = left.alias("l").join(right.alias("r"), [*on, *within], "leftOuter" if unanswered else "inner")
    taken = [F.col(f"l.{c}") for c in opens.columns]
    taken += [F.col(f"r.{c}") for c in follows.columns if c not in opens.columns]
    return joined.select(*taken)


def _drain(writer: DataStreamWriter, more: Callable[[], None] | None) -> None:
    """Process what is available; then bring ``more``, and go on from the checkpoint."""
    writer.trigger(availableNow=True).start().awaitTermination()
    if more:
        more()
        writer.start().awaitTermination()


def drain_append(stream: DataFrame, name: str, more: Callable[[], None] | None = None) -> DataFrame:
    """Process what is available, append it to a table, and read that table.

    ``more`` may bring further input, which a second run then processes.
    """
    spark = stream.sparkSession
    table, checkpoint = work_dir(spark, name), work_dir(spark, f"{name}-checkpoint")
    _drain(stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint), more)
    return spark.read.schema(stream.schema).parquet(table)


def drain_update(stream: DataFrame, name: str, keys: Sequence[str],
                 more: Callable[[], None] | None = None) -> DataFrame:
    """Process what is available in update mode and read the last version per key.

    Each batch writes its changed rows to a partition of its own, replaced if
    the batch is repeated; counts only grow, so the latest batch holds the
    current value of a key. ``more`` may bring further input for a second run.
    """
    spark = stream.sparkSession
    table, checkpoint = work_dir(spark, name), work_dir(spark, f"{name}-checkpoint")

    def write(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(table))

    _drain(stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write), more)
    values = [c for c in stream.columns if c not in keys]
    written = spark.read.schema(f"{_ddl(stream)}, _epoch int").parquet(table)
    latest = F.max_by(F.struct(*values), "_epoch")
    return written.groupBy(*keys).agg(latest.alias("_v")).select(*keys, "_v.*")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
