"""Audience, trending and share-of-voice reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.operators.history import scd2
from feedforge.operators.ranking import rolling_days, running_total, top_per_group

TREND_DAYS = 7  # fixed value: length of the trending window


def daily_active_users(events: DataFrame, user: str, at: str, approximate: bool = False) -> DataFrame:
    """Distinct users per day; the approximate form shuffles one sketch per day."""
    distinct = F.approx_count_distinct(user) if approximate else F.count_distinct(F.col(user))
    return events.groupBy(F.to_date(at).alias("activity_date")).agg(
        distinct.alias("active_users"), F.count(F.lit(1)).alias("n_events"))


def post_reach(events: DataFrame, post: list[str], user: str) -> DataFrame:
    """Distinct accounts per post. The distinct count is first grouped by
    (post, user), so a popular post is spread over many tasks."""
    return events.groupBy(*post).agg(F.count_distinct(F.col(user)).alias("reach"))


def tag_days(tagged: DataFrame, at: str, value: str) -> DataFrame:
    """Engagement per (tag, day) from rows that carry an array of tags."""
    return (tagged.select(F.explode("tags").alias("tag"), F.to_date(at).alias("day"), F.col(value).alias("_v"))
            .groupBy("tag", "day").agg(F.sum("_v").alias("engagement"), F.count(F.lit(1)).alias("mentions")))


def tag_days_of_posts(daily: DataFrame, bridge: DataFrame) -> DataFrame:
    """Engagement per (tag, day) from daily engagement per post and the post-tag
    bridge. The engagements were counted per post and day before the join."""
    tagged = daily.join(bridge.select("post_id", "platform", "hashtag"), ["post_id", "platform"])
    return tagged.groupBy(F.col("hashtag").alias("tag"), F.col("metric_date").alias("day")).agg(
        F.sum("total_engagements").alias("engagement"), F.count(F.lit(1)).alias("mentions"))


def hashtag_totals(tagged: DataFrame, value: str, count: str | None = None) -> DataFrame:
    """Mentions and engagement per tag.

    ``count`` names a column with the number of mentions a row stands for, if
    the rows were summed up before.
    """
    each = F.col(count) if count else F.lit(1)
    return (tagged.select(F.explode("tags").alias("tag"), F.col(value).alias("_v"), each.alias("_n"))
            .groupBy("tag").agg(F.sum("_n").alias("mentions"), F.sum("_v").alias("engagement")))


def trending_tags(days: DataFrame, k: int, window: int = TREND_DAYS) -> DataFrame:
    """Top ``k`` tags of every day by engagement over the last ``window`` days.

    Pass a stored table: its last day is looked up before the sums are planned.
    """
    rolled = rolling_days(days, ["tag"], "day", "engagement", window, "rolling_engagement")
    return top_per_group(rolled, ["day"], "rolling_engagement", k).select(
        "day", "tag", "engagement", "rolling_engagement", "rank")


def share_of_voice(mentions: DataFrame, brand: str = "brand", platform: str = "platform",
                   count: str | None = None) -> DataFrame:
    """Brand mentions as a percentage of all mentions on the platform.

    ``count`` names a column with the number of mentions a row stands for, if
    the rows were summed up before. Mentions are counted per brand first; platform totals are summed from those
    counts and joined back, so no platform is gathered into one window group.
    """
    each = F.col(count) if count else F.lit(1)
    counted = mentions.groupBy(platform, brand).agg(F.sum(each).alias("mentions"))
    totals = counted.groupBy(platform).agg(F.sum("mentions").alias("platform_mentions"))
    return counted.join(totals, platform).withColumn(
        "share_pct", F.round(F.col("mentions") * 100.0 / F.col("platform_mentions"), 4))


def monthly_rollup(fact: DataFrame, calendar: DataFrame, value: str) -> DataFrame:
    """Totals per year and month with subtotals per year and overall.

    The facts are summed per day before they meet the calendar. Facts whose day is
    null or outside of the calendar have a null year and month at level 0, so the
    overall total is that of all facts.
    """
    per_day = fact.groupBy("date_sk").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    dated = per_day.join(calendar.select("date_sk", "year", "month"), "date_sk", "left")
    return dated.rollup("year", "month").agg(
        F.grouping_id().alias("level"), F.sum("_n").alias("n_rows"), F.sum("_v").alias("total_value"))


def eod_cumulative(daily: DataFrame) -> DataFrame:
    """Totals per post at the end of every day with engagement."""
    return running_total(daily, ["post_id", "platform"], "metric_date", {
        "total_likes": "likes", "total_shares": "retweets", "total_comments": "replies",
        "total_views": "views", "total_events": "total_engagements",
    })


def top_posts(enriched: DataFrame, k: int) -> DataFrame:
    """Posts holding the ``k`` highest engagement totals of each platform."""
    return top_per_group(enriched, ["platform"], "total_engagement", k, dense=True)


def dim_users(events: DataFrame, attributes: list[str], user: str = "user_id", at: str = "seen_at",
              tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Type-2 user dimension from attribute snapshots."""
    return scd2(events, user, attributes, at, tie_break, sk="user_sk")


def dim_users_of_tweets(tweets: DataFrame) -> DataFrame:
    """The user dimension with the account data that Silver tweets carry."""
    told = tweets.select(
        "user_id", "platform", F.col("user_follower_count").alias("follower_count"),
        F.col("user_account_type").alias("account_type"),
        F.coalesce(F.col("user_account_type") == "BRAND", F.lit(False)).alias("is_brand"),
        F.col("user_is_verified").alias("is_verified"), "created_at", "ingested_at", "tweet_id")
    return dim_users(told, ["platform", "follower_count", "account_type", "is_brand", "is_verified"],
                     at="created_at", tie_break=("ingested_at", "tweet_id"))
