"""Audience, tag, share and history reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedforge.operators.calendar import dim_date
from feedforge.operators.integrity import series_violations
from feedforge.operators.ranking import running_total
from feedforge.operators.threads import thread_depth
from feedforge.plans import gold, marts

from . import sqltext as Q
from .fixtures import shaped, shaped_sql
from .gold import enriched, fact, staged, users
from .registry import Tables, query

TOP_TAGS = 5
TOP_POSTS = 10


def part_tags(t: Tables):
    """The words of a part's name are its tags."""
    return t.part.select(F.col("p_partkey").alias("l_partkey"), F.split("p_name", " ").alias("tags"))


def part_totals(t: Tables):
    """Line items per part, summed up before anything is joined to them."""
    return t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


# A tag counts on a day for what it had on that day and the six before.
_ROLLED = """(select tag, cast(day + ahead as date) as day, sum(case when ahead = 0 then engagement else 0 end) as engagement,
    sum(engagement) as rolling_engagement
    from (select tag, day, cast(sum(quantity) as bigint) as engagement from {tagged} x group by 1, 2) d,
      (select unnest(range(7))::int as ahead) a group by 1, 2)"""

_TAGGED = """(select unnest(string_split(p_name, ' ')) as tag, cast(l_shipdate as date) as day,
    cast(l_quantity as bigint) as quantity from lineitem join part on l_partkey = p_partkey)"""


@query("hashtag_totals", f"""
    select tag, count(*) as mentions, cast(sum(quantity) as bigint) as engagement from {_TAGGED} x group by 1""")
def _(t):
    return marts.hashtag_totals(part_totals(t).join(part_tags(t), "l_partkey"), "quantity", "n")


@query("trending_tags_7d", f"""
    select cast(day as varchar) as day, tag, engagement, rolling_engagement, rank from (
      select day, tag, engagement::bigint as engagement, rolling_engagement::bigint as rolling_engagement,
        rank() over (partition by day order by rolling_engagement desc) as rank
      from {_ROLLED.format(tagged=_TAGGED)} r
      where day <= (select max(cast(l_shipdate as date)) from lineitem join part on l_partkey = p_partkey)) k
    where rank <= {TOP_TAGS}""")
def _(t):
    per_day = t.lineitem.groupBy("l_partkey", F.to_date("l_shipdate").alias("day")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    tag_days = marts.tag_days(per_day.join(part_tags(t), "l_partkey"), "day", "quantity")
    return marts.trending_tags(t.stored(tag_days, "tag-days"), TOP_TAGS)


@query("daily_active_users", """
    select cast(cast(ts as date) as varchar) as activity_date, count(distinct user_id) as active_users,
      count(*) as n_events from events group by 1""")
def _(t):
    return marts.daily_active_users(t.events, "user_id", "ts")


@query("daily_active_users_approx", """
    select cast(cast(ts as date) as varchar) as activity_date, count(*) as n_events, true as within_error
    from events group by 1""")
def _(t):
    # Three standard errors of the sketch (5 % each), at least two users.
    near = marts.daily_active_users(t.events, "user_id", "ts", approximate=True)
    exact = marts.daily_active_users(t.events, "user_id", "ts").select(
        "activity_date", F.col("active_users").alias("exact"))
    gap = F.abs(F.col("active_users") - F.col("exact"))
    return near.join(exact, "activity_date").select(
        "activity_date", "n_events", (gap <= F.greatest(F.lit(2.0), 0.15 * F.col("exact"))).alias("within_error"))


@query("share_of_voice", """
    select platform, brand, mentions, sum(mentions) over (partition by platform)::bigint as platform_mentions,
      round(mentions * 100.0::double / sum(mentions) over (partition by platform), 4) as share_pct
    from (select p_type as platform, p_brand as brand, count(*) as mentions
          from lineitem join part on l_partkey = p_partkey group by 1, 2) m""")
def _(t):
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("platform"),
                           F.col("p_brand").alias("brand"))
    return marts.share_of_voice(part_totals(t).join(brands, "l_partkey"), count="n")


@query("monthly_rollup", f"""
    select year, month, cast(grouping(year, month) as bigint) as level, count(*) as n_rows,
      round(sum(engagement_value), 4) as total_value
    from {Q.FACT_ENGAGEMENTS} f left join {Q.DIM_DATE} d on f.date_sk = d.date_sk
    group by rollup(year, month)""")
def _(t):
    return marts.monthly_rollup(fact(t), dim_date(t.spark), "engagement_value").withColumn(
        "total_value", F.round("total_value", 4))


@query("post_reach", f"""
    select post_id, platform, count(distinct engaging_user_id) as reach from {Q.STG_ENGAGEMENTS} e group by 1, 2""")
def _(t):
    return marts.post_reach(staged(t), ["post_id", "platform"], "engaging_user_id")


@query("eod_cumulative", f"""
    select post_id, platform, cast(metric_date as varchar) as metric_date, total_engagements,
      sum(likes) over w::bigint as total_likes, sum(retweets) over w::bigint as total_shares,
      sum(replies) over w::bigint as total_comments, sum(views) over w::bigint as total_views,
      sum(total_engagements) over w::bigint as total_events
    from {Q.DAILY} d window w as (partition by post_id, platform order by metric_date)""")
def _(t):
    running = marts.eod_cumulative(gold.daily_engagements(staged(t)))
    return running.select("post_id", "platform", "metric_date", "total_engagements", "total_likes",
                          "total_shares", "total_comments", "total_views", "total_events")


@query("top_posts", f"""
    select post_id, platform, total_engagement, engagement_tier, rank from (
      select *, dense_rank() over (partition by platform order by total_engagement desc) as rank
      from {Q.ENRICHED} e) r where rank <= {TOP_POSTS}""")
def _(t):
    return marts.top_posts(enriched(t), TOP_POSTS).select(
        "post_id", "platform", "total_engagement", "engagement_tier", "rank")


@query("dim_users_scd2", f"""
    select * replace (cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to)
    from {Q.SCD2} u""")
def _(t):
    return users(t)


def daily_series(t: Tables):
    """Views per user and day: the daily snapshots of a running series."""
    return t.events.groupBy("user_id", F.to_date("ts").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("daily_views"))


_CUMULATIVE = """(select user_id, snapshot_date, daily_views,
    cast(sum(daily_views) over (partition by user_id order by snapshot_date) as bigint) as cumulative_views
    from (select user_id, cast(ts as date) as snapshot_date, count(*) as daily_views from events group by 1, 2) d)"""


def cumulative(t: Tables):
    return running_total(daily_series(t), ["user_id"], "snapshot_date", {"cumulative_views": "daily_views"})


@query("snapshot_cumulative", f"""
    select * replace (cast(snapshot_date as varchar) as snapshot_date) from {_CUMULATIVE} c""")
def _(t):
    return cumulative(t)


@query("snapshot_monotonic", """
    select event_type, count(*) as n_rows, count(*) filter (where total < before) as n_falls,
      count(*) filter (where day <= day_before) as n_not_ascending
    from (select event_type, total, day, lag(total) over w as before, lag(day) over w as day_before
          from (select event_type, cast(ts as date) as day, count(*) as total, max(event_id % 1009) * 100000
                  + min(event_id) % 100000 as delivered
                from events group by 1, 2) d
          window w as (partition by event_type order by delivered, day)) x
    group by 1""")
def _(t):
    # The days of a type, delivered in an order that is not that of the days.
    per_day = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("total"),
        (F.max(F.col("event_id") % 1009) * 100000 + F.min("event_id") % 100000).alias("delivered"))
    return series_violations(per_day, "event_type", "day", "total",
                             F.struct("delivered", "day"))


@query("thread_depth", f"""
    with recursive walk as (
      select post_id, comment_id, 0 as recomputed_depth from {shaped_sql('comments')} r
      where parent_comment_id is null
      union all
      select c.post_id, c.comment_id, w.recomputed_depth + 1 from {shaped_sql('comments')} c
      join walk w on c.post_id = w.post_id and c.parent_comment_id = w.comment_id)
    select c.post_id, c.comment_id, c.depth, w.recomputed_depth, w.recomputed_depth = c.depth as matches
    from {shaped_sql('comments')} c left join walk w on c.post_id = w.post_id and c.comment_id = w.comment_id""")
def _(t):
    walked = thread_depth(shaped(t, "comments").drop("body"), ["post_id"], "comment_id",
                          "parent_comment_id")
    return walked.select("post_id", "comment_id", "depth", "recomputed_depth",
                         (F.col("recomputed_depth") == F.col("depth")).alias("matches"))
