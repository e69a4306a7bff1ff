"""Type-2 history and as-of lookup, both at day grain.

Everything is reduced to one row per (key, day) before a window looks at a key,
so the longest window group is the number of days, however many events one key
has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from feedforge.functions.columns import surrogate_key


def end_of_day_state(df: DataFrame, key: str, attributes: Sequence[str], ts: str,
                     tie_break: Sequence[str] = ()) -> DataFrame:
    """Last attribute values per (key, day); partial aggregation before the shuffle."""
    order = F.struct(F.col(ts), *[F.col(c) for c in tie_break])
    state = F.max_by(F.struct(*attributes), order)
    return (df.groupBy(key, F.to_date(ts).alias("_day")).agg(state.alias("_state"))
            .select(key, "_day", *[F.col(f"_state.{a}").alias(a) for a in attributes]))


def scd2(df: DataFrame, key: str, attributes: Sequence[str], ts: str,
         tie_break: Sequence[str] = (), sk: str = "sk") -> DataFrame:
    """Intervals ``[valid_from, valid_to)`` in which the attributes did not change.

    Days that repeat the previous state are dropped before the next interval
    start is looked up. ``valid_to`` is null for the current row.
    """
    daily = end_of_day_state(df, key, attributes, ts, tie_break)
    by_day = Window.partitionBy(key).orderBy("_day")
    changed = daily.withColumn("_starts", _starts(by_day, attributes)).filter("_starts")
    return changed.select(
        surrogate_key([F.col(key), F.col("_day")]).alias(sk),
        key,
        *attributes,
        F.col("_day").alias("valid_from"),
        F.lead("_day").over(by_day).alias("valid_to"),
        F.lead("_day").over(by_day).isNull().alias("is_current"),
    )


def _starts(by_day: WindowSpec, attributes: Sequence[str]) -> Column:
    """Whether a day's state differs from that of the known day before."""
    state = F.struct(*attributes)
    return (F.row_number().over(by_day) == 1) | ~F.lag(state).over(by_day).eqNullSafe(state)


def scd2_merge(history: DataFrame | None, df: DataFrame, key: str, attributes: Sequence[str], ts: str,
               tie_break: Sequence[str] = (), sk: str = "sk") -> DataFrame:
    """The history brought up to date with further snapshots, early, late or repeated.

    The history is one that this function returned, or None to begin with. It is
    what ``scd2`` makes of all snapshots so far, with the days of each interval
    that were ``observed`` and the order of their last snapshot. So a late snapshot
    finds whether its day is known better already; otherwise it splits the interval
    it falls into, or closes the open one. Only keys that the snapshots name are
    computed anew; the rows of others pass through.
    """
    order = F.struct(F.col(ts), *[F.col(c) for c in tie_break])
    fresh = df.groupBy(key, F.to_date(ts).alias("day")).agg(
        F.max(order).alias("at"), F.max_by(F.struct(*attributes), order).alias("state"))
    known = fresh.select(key, "day", "at", "state")
    untouched = None
    if history is not None:
        named = df.select(F.col(key).alias("_named")).distinct()
        same = history[key].eqNullSafe(named["_named"])
        untouched = history.join(named, same, "left_anti")
        stored = history.join(named, same, "left_semi").select(
            key, F.inline("observed"), F.struct(*attributes).alias("state"))
        known = known.unionByName(stored).groupBy(key, "day").agg(
            F.max("at").alias("at"), F.max_by("state", "at").alias("state"))
    by_day = Window.partitionBy(key).orderBy("_day")
    days = known.select(key, F.col("day").alias("_day"), "at", "state.*")
    numbered = days.withColumn("_starts", _starts(by_day, attributes)).withColumn(
        "_interval", F.count_if("_starts").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    intervals = numbered.groupBy(key, "_interval").agg(
        F.min_by(F.struct(*attributes, "_day"), F.struct("_day")).alias("_first"),
        F.sort_array(F.collect_list(F.struct(F.col("_day").alias("day"), "at"))).alias("observed"))
    by_interval = Window.partitionBy(key).orderBy("_interval")
    nothing_after = F.lead("_interval").over(by_interval).isNull()
    rows = intervals.select(
        surrogate_key([F.col(key), F.col("_first._day")]).alias(sk), key, *[F.col(f"_first.{a}").alias(a) for a in attributes],
        F.col("_first._day").alias("valid_from"), F.lead("_first._day").over(by_interval).alias("valid_to"),
        nothing_after.alias("is_current"), "observed")
    return rows if untouched is None else untouched.unionByName(rows)


def as_of(facts: DataFrame, history: DataFrame, key: str, ts: str, take: Sequence[str],
          asked: DataFrame | None = None) -> DataFrame:
    """Attach the history row valid on the day of each fact.

    Only the distinct (key, day) pairs of the facts meet the history; they are
    resolved by carrying the last known row forward over the days, and the facts
    then join on equality. Facts before the first history row get nulls.

    The facts are read twice, for their pairs and for the join. If they are costly,
    let ``asked`` give the pairs (key, ts) from what they were made of; it may hold
    more than theirs.
    """
    row = F.struct(*[F.col(c) for c in take])
    known = history.select(key, F.col("valid_from").alias("_day"), F.lit(False).alias("_asked"),
                           row.alias("_row"))
    asked = (facts if asked is None else asked).select(key, F.to_date(ts).alias("_day")).distinct().select(
        key, "_day", F.lit(True).alias("_asked"), F.lit(None).cast(known.schema["_row"].dataType).alias("_row"))
    # On the same day the history row sorts before the question.
    so_far = Window.partitionBy(key).orderBy("_day", "_asked") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    resolved = (known.unionByName(asked)
                .withColumn("_row", F.last("_row", ignorenulls=True).over(so_far))
                .filter("_asked")
                .select(key, "_day", *[F.col(f"_row.{c}").alias(c) for c in take]))
    return (facts.withColumn("_day", F.to_date(ts))
            .join(resolved, [key, "_day"], "left").drop("_day"))
