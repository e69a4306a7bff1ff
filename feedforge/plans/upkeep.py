"""Gold tables kept up to date by what is new, instead of being rebuilt.

Each table is a committed one (``sources/snapshots.py``): an update reads the
partitions that the new rows touch, replaces them and commits. Which batches of a
stream are in a table is noted in the same commit, so a batch that comes again
after a failure is left out, and one that was lost before its commit is not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedforge.operators.history import scd2_merge
from feedforge.sources.snapshots import CommitConflict, Snapshot, publish, read_snapshot, snapshot

BUCKETS = 64
#: Sketches of 2 ** 12 registers: relative standard error 1.3 %.
SKETCH_BITS = 12
SKETCH_ERROR = 0.013
ATTEMPTS = 10

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def _merged(new: DataFrame, root: str, part: str, merge: Merge, stream: str | None = None,
            batch: int | None = None) -> bool:
    """Replace the partitions that ``new`` touches by ``merge(what they hold, new)``.

    False if the batch was in the table already. Batches of a stream are numbered
    upwards and come in order, as micro-batches do.
    """
    spark = new.sparkSession
    for _ in range(ATTEMPTS):
        before = snapshot(spark, root)
        if before and stream is not None and before.notes.get(stream, -1) >= batch:
            return False
        touched = {_part_name(r[0]) for r in new.select(part).distinct().collect()}  # days or buckets, not keys
        covers = lambda values: values[part] in touched
        old = read_snapshot(spark, root, where=covers, version=before.version) if before and _any(before, covers) else None
        try:
            publish(merge(old, new), root, [part], covers, rebalance=True, after=before.version if before else -1,
                    notes=None if stream is None else {stream: batch})
            return True
        except CommitConflict:  # another writer came first: merge with what it wrote
            continue
    raise CommitConflict(f"{root}: other writers committed {ATTEMPTS} times")


def _part_name(value: object) -> str | None:
    return None if value is None else str(value)


def _any(before: Snapshot, covers: Callable[[dict], bool]) -> bool:
    return bool(before.folders(covers))


def update_dim_users(snapshots: DataFrame, root: str, attributes: Sequence[str], user: str = "user_id",
                     at: str = "seen_at", tie_break: Sequence[str] = (), buckets: int = BUCKETS,
                     stream: str | None = None, batch: int | None = None) -> bool:
    """Bring the type-2 user dimension up to date with further account snapshots.

    Users lie in buckets of a hash of their id; only buckets with a user among the
    snapshots are read and written, and only those users' intervals are computed.
    """
    bucket = F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        history = old.drop("bucket") if old is not None else None
        rows = scd2_merge(history, new.drop("bucket"), user, attributes, at, tie_break, sk="user_sk")
        return rows.withColumn("bucket", bucket)

    return _merged(snapshots.withColumn("bucket", bucket), root, "bucket", merge, stream, batch)


def update_totals(events: DataFrame, root: str, keys: Sequence[str], at: str, measures: dict[str, Column],
                  stream: str, batch: int) -> bool:
    """Add a batch of events to stored sums per key and day; a repeated batch adds nothing.

    ``measures`` are sums or counts. Events of any age may come: only the days
    they fall on are read and written.
    """
    new = events.groupBy(*keys, F.to_date(at).alias("metric_date")).agg(*[m.alias(n) for n, m in measures.items()])

    def merge(old: DataFrame | None, fresh: DataFrame) -> DataFrame:
        both = fresh if old is None else old.unionByName(fresh)
        return both.groupBy(*keys, "metric_date").agg(*[F.sum(n).alias(n) for n in measures])

    return _merged(new, root, "metric_date", merge, stream, batch)


def totals_writer(root: str, keys: Sequence[str], at: str, measures: dict[str, Column],
                  stream: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps daily totals; every micro-batch counts once."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()  # bounded by the size of a micro-batch; read for its days and for its sums
        try:
            update_totals(batch, root, keys, at, measures, stream, epoch)
        finally:
            batch.unpersist()

    return write


def update_user_sketches(events: DataFrame, root: str, user: str, at: str, groups: Sequence[str] = (),
                         bits: int = SKETCH_BITS) -> bool:
    """Add events to the stored sketches of distinct users per day (and group).

    A sketch does not count a user twice, so repeated batches change nothing.
    """
    new = events.groupBy(*groups, F.to_date(at).alias("day")).agg(F.hll_sketch_agg(user, bits).alias("users"))

    def merge(old: DataFrame | None, fresh: DataFrame) -> DataFrame:
        both = fresh if old is None else old.unionByName(fresh)
        return both.groupBy(*groups, "day").agg(F.hll_union_agg("users").alias("users"))

    return _merged(new, root, "day", merge)


def distinct_users(sketches: DataFrame, period: Column, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct users per period (a week, a month, ...) from daily sketches, without the events."""
    return sketches.groupBy(*groups, period.alias("period_start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users"))


def read_kept(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """A kept table; of the user dimension without what only its upkeep needs."""
    df = read_snapshot(spark, root)
    return df.select(*columns) if columns else df.drop("bucket", "observed")
