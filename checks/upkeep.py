"""Tables kept up to date batch by batch against one pass over everything."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.plans.marts import eod_cumulative
from feedforge.plans.upkeep import (
    SKETCH_ERROR, distinct_users, read_kept, totals_writer, update_dim_users, update_totals, update_user_sketches,
)
from feedforge.sources.snapshots import read_snapshot
from feedforge.sources.workdir import work_dir

from . import sqltext as Q
from .fixtures import shaped
from .registry import Tables, query
from .streams import table_stream

# In this order: a first stretch, a later one, one from before both, and stragglers of all days.
BATCHES = (
    "event_id % 5 > 0 and ts >= '2024-01-11' and ts < '2024-01-21'",
    "event_id % 5 > 0 and ts >= '2024-01-21'",
    "event_id % 5 > 0 and ts < '2024-01-11'",
    "event_id % 5 = 0",
)


@query("dim_users_kept", f"select * from {Q.SCD2} s")
def _(t):
    root = work_dir(t.spark, "dim-users")
    told = shaped(t, "users")
    for n, chosen in enumerate((*BATCHES, BATCHES[3])):  # the last one comes twice
        batch = told.where(chosen.replace("ts ", "seen_at "))
        update_dim_users(batch, root, ["account_type", "is_verified"], tie_break=("event_id",), buckets=8,
                         stream="accounts", batch=min(n, 3))
    return read_kept(t.spark, root)


_KEYS = ["event_type", "user_id"]
_DAILY = """(select event_type, user_id, cast(ts as date) as metric_date, count(*) as n_events,
    count(*) filter (where value >= 50) as n_large from events group by 1, 2, 3)"""


@query("daily_totals_kept", f"select * from {_DAILY} d")
def _(t):
    root = work_dir(t.spark, "daily-totals")
    measures = {"n_events": F.count(F.lit(1)), "n_large": F.count_if(F.col("value") >= 50)}
    for n, chosen in enumerate(BATCHES):
        for _ in range(1 + n % 2):  # some batches come again
            update_totals(t.events.where(chosen), root, _KEYS, "ts", measures, "events", n)
    return read_snapshot(t.spark, root)


@query("eod_totals_kept", """
    select post_id, platform, cast(metric_date as varchar) as metric_date, total_events from (
      select user_id % 7 as post_id, event_type as platform, cast(ts as date) as metric_date,
        sum(count(*)) over (partition by user_id % 7, event_type order by cast(ts as date))::bigint as total_events
      from events group by 1, 2, 3) s""")
def _(t):
    root, checkpoint = work_dir(t.spark, "stream-totals"), work_dir(t.spark, "stream-totals-checkpoint")
    kinds = {"likes": "click", "retweets": "purchase", "replies": "signup", "views": "view"}
    measures = {**{n: F.count_if(F.col("platform") == e) for n, e in kinds.items()}, "total_engagements": F.count(F.lit(1))}
    posts = table_stream(t, "events").select((F.col("user_id") % 7).alias("post_id"), F.col("event_type").alias("platform"), "ts")
    writer = totals_writer(root, ["post_id", "platform"], "ts", measures, "events")
    posts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(writer).trigger(availableNow=True).start().awaitTermination()
    return eod_cumulative(read_snapshot(t.spark, root)).select("post_id", "platform", "metric_date", "total_events")


_PERIODS = ("day", "week", "month")


@query("active_users_sketched", " union all ".join(
    f"""select '{p}' as period, cast(cast(date_trunc('{p}', ts) as date) as varchar) as period_start,
      count(distinct user_id) as exact_users, true as within_error from events group by 2""" for p in _PERIODS))
def _(t):
    root = work_dir(t.spark, "user-sketches")
    for chosen in (*BATCHES, BATCHES[0]):  # a repeated batch changes nothing
        update_user_sketches(t.events.where(chosen), root, "user_id", "ts")
    sketches = read_snapshot(t.spark, root)

    def compared(period: str) -> DataFrame:
        start = F.to_date(F.date_trunc(period, F.col("day").cast("timestamp")))
        sketched = distinct_users(sketches, start)
        exact = t.events.groupBy(F.to_date(F.date_trunc(period, F.col("ts").cast("timestamp"))).alias("period_start")).agg(
            F.count_distinct("user_id").alias("exact_users"))
        off = F.abs(F.col("active_users") - F.col("exact_users"))
        # Four standard errors.
        return exact.join(sketched, "period_start", "left").select(
            F.lit(period).alias("period"), "period_start", "exact_users",
            F.coalesce(off <= F.ceil(F.col("exact_users") * 4 * SKETCH_ERROR), F.lit(False)).alias("within_error"))

    return reduce(DataFrame.union, map(compared, _PERIODS))
