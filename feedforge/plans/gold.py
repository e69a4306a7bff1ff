"""Silver -> Gold: staging projections, enriched posts, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedforge.functions import columns as C
from feedforge.operators.history import as_of

POST_KEY = ("post_id", "platform")


def _pick(df: DataFrame, names: dict[str, str], defaults: dict[str, object]) -> DataFrame:
    """Project ``new: old`` with a default for missing values."""
    return df.select(*[
        (F.coalesce(F.col(old), F.lit(defaults[new])) if new in defaults else F.col(old)).alias(new)
        for new, old in names.items()
    ])


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def stg_tweets(tweets: DataFrame) -> DataFrame:
    names = {
        "post_id": "tweet_id",
        **_same("user_id", "platform", "content", "hashtags", "mentions", "language", "is_retweet",
                "is_reply", "media_type", "content_length", "hashtag_count", "has_media",
                "likes_count", "retweets_count", "replies_count", "impressions_count",
                "quote_count", "engagement_total"),
        "author_follower_count": "user_follower_count",
        "author_account_type": "user_account_type",
        "author_is_verified": "user_is_verified",
        "posted_at": "created_at",
        **_same("ingested_at", "silver_batch_id", "silver_processed_at"),
    }
    zero = ("content_length", "hashtag_count", "likes_count", "retweets_count", "replies_count",
            "impressions_count", "quote_count", "engagement_total", "author_follower_count")
    false = ("is_retweet", "is_reply", "has_media", "author_is_verified")
    return _pick(tweets, names, {**dict.fromkeys(zero, 0), **dict.fromkeys(false, False)})


def stg_engagements(engagements: DataFrame) -> DataFrame:
    names = {
        **_same("engagement_id", "post_id", "engaging_user_id", "post_author_id", "platform",
                "engagement_type"),
        "engagement_content": "content",
        "engagement_value": "engagement_value",
        "engaged_at": "created_at",
        **_same("ingested_at", "silver_batch_id"),
    }
    return _pick(engagements, names, {"engagement_value": C.OTHER_WEIGHT})


def stg_posts(posts: DataFrame) -> DataFrame:
    counts = ("likes_count", "shares_count", "comments_count", "impressions_count")
    names = _same("post_id", "user_id", "platform", "content", "hashtags", "posted_at", *counts,
                  "ingested_at", "silver_batch_id")
    if "content_length" in posts.columns:
        names |= _same("content_length")
    return _pick(posts, names, dict.fromkeys(counts, 0)).withColumn("post_date", F.to_date("posted_at"))


def previewed(posts: DataFrame) -> DataFrame:
    """Posts with the beginning of their text and its length, which is all that Gold keeps of it."""
    return posts.withColumns({"content_length": F.length("content"),
                              "content": F.left(F.col("content"), F.lit(C.PREVIEW_CHARS))})


def posts_enriched(staged: DataFrame) -> DataFrame:
    """Date parts, totals, rate and tier of every staged post."""
    at = F.col("posted_at")
    total = F.col("likes_count") + F.col("shares_count") + F.col("comments_count")
    return staged.withColumns({
        "post_year": F.year(at),
        "post_month": F.month(at),
        "post_day": F.dayofmonth(at),
        "post_day_of_week": C.day_of_week(at),
        "post_hour": F.hour(at),
        "posted_on_weekend": C.is_weekend(at),
        "total_engagement": total,
        "engagement_rate_pct": C.engagement_rate_pct(total, "impressions_count"),
        "engagement_tier": C.engagement_tier(total),
        "has_hashtags": C.array_len("hashtags") > 0,
    })


def dim_posts(enriched: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per (post_id, platform) with a content preview."""
    return enriched.select(
        C.surrogate_key(POST_KEY).alias("post_sk"),
        "post_id", "user_id", "platform",
        F.left(F.col("content"), F.lit(C.PREVIEW_CHARS)).alias("content_preview"),
        (F.col("content_length") if "content_length" in enriched.columns else F.length("content")).alias("content_length"),
        "hashtags", "likes_count", "shares_count", "comments_count", "impressions_count",
        "total_engagement", "engagement_rate_pct", "engagement_tier", "has_hashtags",
        "post_day_of_week", "posted_on_weekend", "post_date", "post_year", "post_month",
        "post_day", "post_hour", "posted_at", "ingested_at", "silver_batch_id",
        (now if now is not None else F.current_timestamp()).alias("gold_loaded_at"),
    )


def dim_platforms(posts: DataFrame) -> DataFrame:
    """One row per platform seen."""
    return posts.select("platform").distinct().select(
        C.surrogate_key(["platform"]).alias("platform_sk"), "platform")


def post_hashtags(posts: DataFrame) -> DataFrame:
    """Bridge: one row per distinct (post, tag); tags are folded to lower case."""
    return (posts.select(*POST_KEY, F.explode("hashtags").alias("_tag"))
            .select(C.surrogate_key(POST_KEY).alias("post_sk"), *POST_KEY,
                    C.tidy("_tag", "lower").alias("hashtag"))
            .filter(F.col("hashtag") != "")
            .distinct()
            .withColumn("hashtag_sk", C.surrogate_key(["hashtag"])))


def dim_hashtags(bridge: DataFrame) -> DataFrame:
    """One row per tag with the number of posts that carry it."""
    return bridge.groupBy("hashtag").agg(F.count(F.lit(1)).alias("n_posts")).select(
        C.surrogate_key(["hashtag"]).alias("hashtag_sk"), "hashtag", "n_posts")


def fact_engagements(staged: DataFrame, enriched: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per engagement with the key and date of its post, if the post is known.

    Only the keys and dates of the posts take part in the join. A post with very
    many engagements makes its partition of the left side large; adaptive
    execution splits that partition, since a left outer join may be split there.
    """
    known = enriched.select(*POST_KEY, "post_date", C.surrogate_key(POST_KEY).alias("post_sk"))
    return staged.join(known, list(POST_KEY), "left").select(
        C.surrogate_key(["engagement_id"]).alias("engagement_sk"),
        "engagement_id", "post_id", "engaging_user_id", "post_author_id", "platform",
        C.date_key(F.to_date("engaged_at")).alias("date_sk"),
        "engagement_type",
        F.col("engaged_at").alias("engagement_timestamp"),
        "engagement_value", "engagement_content", "post_sk", "post_date", "ingested_at", "silver_batch_id",
        (now if now is not None else F.current_timestamp()).alias("gold_loaded_at"),
    )


_PER_TYPE = {"likes": "LIKE", "retweets": "RETWEET", "replies": "REPLY", "quotes": "QUOTE",
             "views": "VIEW"}


def daily_engagements(staged: DataFrame, at: str = "engaged_at") -> DataFrame:
    """Counts per (post, platform, day), in total and per type.

    Reads the engagements directly, not the fact table: nothing here needs the
    post, so the aggregate does not wait for a join, and its partial counts
    shrink a popular post to a row per day before the shuffle.
    """
    kind = F.col("engagement_type")
    return staged.groupBy(*POST_KEY, F.to_date(at).alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_engagements"),
        *[F.count_if(kind == t).alias(c) for c, t in _PER_TYPE.items()],
        F.sum("engagement_value").alias("total_engagement_value"),
    )


_EVENT_METRICS = {
    "event_likes": "likes", "event_shares": "retweets", "event_replies": "replies",
    "event_quotes": "quotes", "event_views": "views",
    "total_engagement_events": "total_engagements",
}
_CONTEXT = ("engagement_rate_pct", "engagement_tier", "total_engagement", "post_date", "post_year",
            "post_month", "post_day", "post_day_of_week", "posted_on_weekend", "has_hashtags",
            "posted_at", "ingested_at")


def _metrics(joined: DataFrame, day: str, now: Column | None) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return joined.select(
        C.surrogate_key([*POST_KEY, day]).alias("metric_sk"),
        "post_id", "user_id", "platform",
        C.date_key(day).alias("date_sk"),
        F.col("likes_count").alias("snapshot_likes"),
        F.col("shares_count").alias("snapshot_shares"),
        F.col("comments_count").alias("snapshot_comments"),
        F.col("impressions_count").alias("snapshot_impressions"),
        *[F.coalesce(F.col(old), zero).alias(new) for new, old in _EVENT_METRICS.items()],
        F.coalesce("total_engagement_value", F.lit(0.0)).alias("total_engagement_value"),
        *_CONTEXT,
        (now if now is not None else F.current_timestamp()).alias("gold_loaded_at"),
    )


def fact_post_metrics(enriched: DataFrame, daily: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per post: its snapshot and the engagement of its first day.

    Engagement on later days does not match; ``fact_post_metrics_daily`` has it.
    """
    first_day = daily.withColumnRenamed("metric_date", "post_date")
    joined = enriched.join(first_day, [*POST_KEY, "post_date"], "left")
    return _metrics(joined, "post_date", now)


def fact_post_metrics_daily(enriched: DataFrame, daily: DataFrame,
                            now: Column | None = None) -> DataFrame:
    """One row per (post, platform, day): every day with engagement, and the day
    of posting even without any."""
    counts = [c for c in daily.columns if c not in (*POST_KEY, "metric_date")]
    posted = enriched.select(
        *POST_KEY, F.col("post_date").alias("metric_date"),
        *[F.lit(0).cast(daily.schema[c].dataType).alias(c) for c in counts])
    days = daily.unionByName(posted).groupBy(*POST_KEY, "metric_date").agg(
        *[F.sum(c).alias(c) for c in counts])
    joined = days.join(enriched, list(POST_KEY), "inner")
    return _metrics(joined, "metric_date", now).withColumn(
        "days_since_post", F.datediff(F.to_date(F.col("date_sk").cast("string"), "yyyyMMdd"), "post_date"))


def fact_with_keys(fact: DataFrame, history: DataFrame, platforms: DataFrame,
                   engagements: DataFrame | None = None) -> DataFrame:
    """Add user_sk and platform_sk to the fact; null where the dimension has no row.

    ``history`` is the type-2 user dimension: the key is that of the version valid
    on the day of the engagement. Pass the dimensions as stored tables: the
    planner then knows their size and sends the small ones (surely the platforms)
    to every task. With the staged ``engagements`` that the fact was made of, the
    users and days to look up come from there, and the fact is computed once.
    """
    asked = engagements.select("engaging_user_id", F.col("engaged_at").alias("engagement_timestamp")) \
        if engagements is not None else None
    who = history.select(F.col("user_id").alias("engaging_user_id"), "valid_from", "user_sk")
    return as_of(fact, who, "engaging_user_id", "engagement_timestamp", ["user_sk"], asked).join(
        platforms.select("platform", "platform_sk"), "platform", "left")
