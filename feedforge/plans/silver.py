"""Bronze -> Silver: cleaned tweets, engagements and unified posts.

Deduplication comes right after the key check and the timestamp parse. The
derived columns depend on their own row only, so computing them afterwards
gives the same table while they never travel through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedforge.functions import columns as C
from feedforge.operators.cleaning import fill_nulls, normalize_ts, reject_split
from feedforge.operators.dedup import dedup_latest
from feedforge.sources.schemas import CLEAN_KEYS

# Defaults of missing tweet counters and flags.
TWEET_DEFAULTS = {
    "likes_count": 0, "retweets_count": 0, "replies_count": 0, "impressions_count": 0,
    "quote_count": 0, "is_retweet": False, "is_reply": False,
}
SILVER_LAYER = "silver"


def _stamp(batch_id: str, now: Column | None, layer: bool) -> dict[str, Column]:
    tags = {
        "silver_batch_id": F.lit(batch_id),
        "silver_processed_at": now if now is not None else F.current_timestamp(),
    }
    return {**tags, "silver_layer": F.lit(SILVER_LAYER)} if layer else tags


def _latest(raw: DataFrame, entity: str, key: str, tie_break: Sequence[str], within: Sequence[str]) -> DataFrame:
    valid, _ = reject_split(raw, CLEAN_KEYS[entity])
    timed = normalize_ts(valid, ("created_at", "ingested_at"))
    return dedup_latest(timed, [key, *within], "ingested_at", tie_break)


def latest_tweets(raw: DataFrame, tie_break: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
    """One valid row per tweet, not cleaned yet; ``within`` adds columns to the
    dedup key (day partitions, when several days are processed at once)."""
    return _latest(raw, "twitter.tweets", "tweet_id", tie_break, within)


def clean_tweets(raw: DataFrame, batch_id: str, tie_break: Sequence[str] = (),
                 within: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """One cleaned row per tweet (and ``within``)."""
    return tidy_tweets(latest_tweets(raw, tie_break, within), batch_id, now)


def tidy_tweets(latest: DataFrame, batch_id: str, now: Column | None = None) -> DataFrame:
    """Text, counters and derived columns of rows that are one per tweet already."""
    folded = latest.withColumns({
        "content": C.tidy("content"),
        "platform": C.tidy("platform", "lower"),
        "language": C.tidy("language", "lower"),
        "media_type": C.tidy("media_type", "lower"),
        "user_account_type": C.tidy("user_account_type", "upper"),
    })
    counted = fill_nulls(folded, TWEET_DEFAULTS).withColumns({
        c: C.floor_zero(c) for c in ("likes_count", "retweets_count", "impressions_count")
    })
    return counted.withColumns({
        "content_length": F.length("content"),
        "hashtag_count": C.array_len("hashtags"),
        "mention_count": C.array_len("mentions"),
        "has_media": F.col("media_type").isNotNull(),
        "engagement_total": F.col("likes_count") + F.col("retweets_count") + F.col("replies_count"),
        **_stamp(batch_id, now, layer=True),
    })


def latest_engagements(raw: DataFrame, tie_break: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
    """One valid row per engagement (and ``within``), not cleaned yet."""
    return _latest(raw, "twitter.engagements", "engagement_id", tie_break, within)


def clean_engagements(raw: DataFrame, batch_id: str, tie_break: Sequence[str] = (),
                      within: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """One cleaned row per engagement, with its type folded and weighted."""
    return tidy_engagements(latest_engagements(raw, tie_break, within), batch_id, now)


def tidy_engagements(latest: DataFrame, batch_id: str, now: Column | None = None) -> DataFrame:
    """Folded type and weight of rows that are one per engagement already."""
    typed = latest.withColumns({
        "platform": C.tidy("platform", "lower"),
        "engagement_type": C.engagement_type("engagement_type"),
    })
    return typed.withColumns({
        "engagement_value": C.engagement_weight("engagement_type"),
        **_stamp(batch_id, now, layer=False),
    })


def _conform(df: DataFrame, platform: str, batch: Column, mapping: dict[str, str | Column],
             within: Sequence[str]) -> DataFrame:
    """Project a platform's records onto the unified post columns."""
    none = F.lit(0).cast("bigint")
    chosen = {"platform": F.lit(platform), "shares_count": none, "impressions_count": none,
              "ingested_at": F.col("ingested_at"), "silver_batch_id": batch,
              **{k: F.col(v) if isinstance(v, str) else v for k, v in mapping.items()}}
    order = ("post_id", "user_id", "platform", "content", "hashtags", "posted_at", "likes_count",
             "shares_count", "comments_count", "impressions_count", "ingested_at", "silver_batch_id")
    return df.select(*[chosen[c].alias(c) for c in order], *within)


def posts_from_tweets(tweets: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return _conform(tweets, "twitter", F.col("silver_batch_id"), {
        "post_id": "tweet_id", "user_id": "user_id", "content": "content", "hashtags": "hashtags",
        "posted_at": "created_at", "likes_count": "likes_count", "shares_count": "retweets_count",
        "comments_count": "replies_count", "impressions_count": "impressions_count",
    }, within)


def posts_from_videos(videos: DataFrame, batch_id: str, within: Sequence[str] = ()) -> DataFrame:
    timed = normalize_ts(videos, ("published_at", "ingested_at"))
    return _conform(timed, "youtube", F.lit(batch_id), {
        "post_id": "video_id", "user_id": "channel_id", "content": "title", "hashtags": "tags",
        "posted_at": "published_at", "likes_count": "like_count",
        "comments_count": "comment_count", "impressions_count": "view_count",
    }, within)


def posts_from_reddit(posts: DataFrame, batch_id: str, within: Sequence[str] = ()) -> DataFrame:
    timed = normalize_ts(posts, ("posted_at", "ingested_at"))
    return _conform(timed, "reddit", F.lit(batch_id), {
        "post_id": "post_id", "user_id": "author_user_id", "content": "title", "hashtags": "tags",
        "posted_at": "posted_at", "likes_count": "score", "comments_count": "num_comments",
    }, within)


def _clean_post(df: DataFrame) -> DataFrame:
    keyed, _ = reject_split(df, ("post_id", "user_id"))
    counts = ("likes_count", "shares_count", "comments_count", "impressions_count")
    return fill_nulls(keyed, dict.fromkeys(counts, 0)).withColumns({
        "content": C.tidy("content"), **{c: C.floor_zero(c) for c in counts},
    })


def _other_posts(videos: DataFrame, reddit: DataFrame, batch_id: str, within: Sequence[str]) -> DataFrame:
    return posts_from_videos(videos, batch_id, within).unionByName(posts_from_reddit(reddit, batch_id, within))


def posts_of_other_platforms(videos: DataFrame, reddit: DataFrame, batch_id: str, tie_break: Sequence[str] = (),
                             within: Sequence[str] = ()) -> DataFrame:
    """The rows of ``posts_unified`` that are no tweets.

    A post is told by its id and platform, so where the tweets are one row per
    tweet (and ``within``) already, these and ``posts_from_tweets`` are all posts,
    and the texts of the tweets need no second shuffle.
    """
    return dedup_latest(_other_posts(videos, reddit, batch_id, within), ["post_id", "platform", *within],
                        "ingested_at", tie_break)


def posts_unified(tweets: DataFrame, videos: DataFrame, reddit: DataFrame, batch_id: str,
                  tie_break: Sequence[str] = (), within: Sequence[str] = (),
                  clean: bool = False) -> DataFrame:
    """Posts of all platforms, one row per (post_id, platform).

    ``tweets`` is the cleaned table, the other two are raw. By default the raw
    rows keep their nulls and negative counts; ``clean`` applies the tweet rules
    to every platform.
    """
    merged = posts_from_tweets(tweets, within).unionByName(_other_posts(videos, reddit, batch_id, within))
    if clean:
        merged = _clean_post(merged)
    return dedup_latest(merged, ["post_id", "platform", *within], "ingested_at", tie_break)
