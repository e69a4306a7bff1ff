"""The rules of every table. All limits, sets and patterns are fixed values."""

from __future__ import annotations

from .quality import (
    Suite, between, exists, in_set, matches, not_null, row_count, unique, unique_proportion,
)

UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
PLATFORMS = ("twitter", "youtube", "reddit")
TYPES = ("LIKE", "RETWEET", "REPLY", "QUOTE", "VIEW", "UNKNOWN")
TIERS = ("viral", "high", "medium", "low")
FIRST_KEY, LAST_KEY = 20200101, 20301231

BRONZE_TWEETS = Suite("bronze.tweets", "bronze", False, (
    row_count(1, 10_000_000),
    *exists("tweet_id", "user_id", "platform", "created_at", "ingested_at", "batch_id"),
    *not_null("tweet_id", "user_id"),
    *not_null("platform", mostly=0.99),
    *not_null("ingested_at"),
    in_set("platform", ("twitter", "Twitter", "TWITTER"), 0.99),
    between("likes_count", 0, 100_000_000, 0.99),
    between("retweets_count", 0, 50_000_000, 0.99),
    matches("tweet_id", UUID, 0.99),
))

BRONZE_ENGAGEMENTS = Suite("bronze.engagements", "bronze", False, (
    row_count(0, 50_000_000),
    *exists("engagement_id", "post_id", "engaging_user_id", "engagement_type", "platform"),
    *not_null("engagement_id", "post_id"),
    *not_null("engagement_type", mostly=0.99),
    in_set("engagement_type", ("LIKE", "RETWEET", "REPLY", "QUOTE", "VIEW",
                               "like", "retweet", "reply", "quote", "view"), 0.95),
    in_set("platform", ("twitter", "youtube", "reddit", "Twitter", "YouTube", "Reddit"), 0.99),
))

SILVER_TWEETS = Suite("silver.tweets", "silver", True, (
    row_count(1, 10_000_000),
    *exists("tweet_id", "user_id", "platform", "content", "created_at", "ingested_at",
            "silver_batch_id", "engagement_total"),
    *not_null("tweet_id", "user_id", "platform", "created_at", "silver_batch_id"),
    *unique("tweet_id", mostly=0.999),
    unique_proportion("tweet_id", 0.999, 1.0),
    in_set("platform", ("twitter",)),
    in_set("user_account_type", ("USER", "BRAND", "INFLUENCER"), 0.99),
    between("likes_count", 0, 100_000_000),
    between("retweets_count", 0, 50_000_000),
    between("impressions_count", 0, 1_000_000_000),
    between("engagement_total", 0, 200_000_000),
    between("content_length", 0, 280, 0.95),
    matches("tweet_id", UUID),
    matches("silver_batch_id", UUID),
))

# The event time is still called created_at here; it is renamed in staging.
SILVER_ENGAGEMENTS = Suite("silver.engagements", "silver", True, (
    row_count(0, 50_000_000),
    *exists("engagement_id", "post_id", "engaging_user_id", "engagement_type",
            "engagement_value", "created_at"),
    *not_null("engagement_id", "post_id", "engaging_user_id", "engagement_type"),
    *unique("engagement_id", mostly=0.999),
    in_set("engagement_type", TYPES),
    between("engagement_value", 0.0, 10.0),
    in_set("platform", PLATFORMS),
))

SILVER_POSTS = Suite("silver.posts", "silver", True, (
    row_count(1, 50_000_000),
    *exists("post_id", "user_id", "platform", "posted_at"),
    *not_null("post_id", "user_id", "platform"),
    in_set("platform", PLATFORMS),
    between("likes_count", 0, 100_000_000),
    between("shares_count", 0, 50_000_000),
    between("comments_count", 0, 10_000_000),
))

GOLD_FACT_ENGAGEMENTS = Suite("gold.fact_engagements", "gold", False, (
    row_count(1, 100_000_000),
    *exists("engagement_sk", "engagement_id", "post_id", "engaging_user_id", "platform",
            "date_sk", "engagement_type", "engagement_value", "gold_loaded_at"),
    *not_null("engagement_sk", "engagement_id", "post_id", "platform", "date_sk"),
    *unique("engagement_sk", mostly=0.9999),
    in_set("platform", PLATFORMS),
    in_set("engagement_type", TYPES),
    between("engagement_value", 0.0, 10.0),
    between("date_sk", FIRST_KEY, LAST_KEY),
))

GOLD_FACT_POST_METRICS = Suite("gold.fact_post_metrics", "gold", False, (
    row_count(1, 100_000_000),
    *exists("metric_sk", "post_id", "platform", "date_sk", "engagement_rate_pct",
            "engagement_tier"),
    *not_null("metric_sk", "post_id", "date_sk"),
    *unique("metric_sk", mostly=0.9999),
    between("engagement_rate_pct", 0.0, 100.0, 0.99),
    in_set("engagement_tier", TIERS),
    between("date_sk", FIRST_KEY, LAST_KEY),
))

# Shorter checks run in code rather than from the full suites.
QUICK_BRONZE_TWEETS = Suite("quick.bronze.tweets", "bronze", False, (
    row_count(1),
    *not_null("tweet_id", "user_id", "platform"),
    *not_null("created_at", mostly=0.99),
    in_set("platform", ("twitter",), 0.999),
    between("likes_count", 0, mostly=0.999),
    between("retweets_count", 0, mostly=0.999),
    *unique("tweet_id", mostly=0.99),
))

QUICK_SILVER_TWEETS = Suite("quick.silver.tweets", "silver", True, (
    row_count(1),
    *not_null("tweet_id", "user_id", "platform", "created_at", "likes_count",
              "retweets_count", "silver_batch_id"),
    *unique("tweet_id"),
    in_set("platform", ("twitter",)),
    between("likes_count", 0),
    between("retweets_count", 0),
    in_set("user_account_type", ("BRAND", "INFLUENCER", "USER"), 0.999),
))

QUICK_GOLD_ENGAGEMENTS = Suite("quick.gold.fact_engagements", "gold", False, (
    row_count(1),
    *not_null("engagement_sk", "engagement_id", "post_id", "date_sk"),
    *unique("engagement_sk", "engagement_id"),
    in_set("engagement_type", TYPES),
    in_set("platform", PLATFORMS),
    between("engagement_value", 0),
    between("date_sk", FIRST_KEY, LAST_KEY),
))

# Column constraints declared with the models (every row has to pass).
TABLE_TESTS = {
    "tweets": Suite("tests.tweets", "silver", True, (
        *not_null("tweet_id"), *unique("tweet_id"), *not_null("user_id", "platform"),
        in_set("platform", ("twitter",)), *not_null("created_at", "likes_count"),
        between("likes_count", 0), *not_null("silver_batch_id"),
    )),
    "engagements": Suite("tests.engagements", "silver", True, (
        *not_null("engagement_id"), *unique("engagement_id"),
        *not_null("post_id", "engaging_user_id", "engagement_type"),
        in_set("engagement_type", TYPES), *not_null("engagement_value"),
        between("engagement_value", 0),
    )),
    "posts": Suite("tests.posts", "silver", True, (
        *not_null("post_id", "user_id", "platform"), in_set("platform", PLATFORMS),
        *not_null("posted_at"),
    )),
    "fact_engagements": Suite("tests.fact_engagements", "gold", False, (
        *not_null("engagement_sk"), *unique("engagement_sk"),
        *not_null("engagement_id"), *unique("engagement_id"),
        *not_null("post_id", "engaging_user_id", "platform"), in_set("platform", PLATFORMS),
        *not_null("date_sk", "engagement_type"), in_set("engagement_type", TYPES),
        *not_null("engagement_value"), between("engagement_value", 0), *not_null("gold_loaded_at"),
    )),
    "fact_post_metrics": Suite("tests.fact_post_metrics", "gold", False, (
        *not_null("metric_sk"), *unique("metric_sk"), *not_null("post_id", "platform"),
        in_set("platform", PLATFORMS), *not_null("date_sk"),
        between("engagement_rate_pct", 0, 100), in_set("engagement_tier", TIERS),
    )),
    "dim_date": Suite("tests.dim_date", "gold", False, (
        *not_null("date_sk"), *unique("date_sk"), *not_null("full_date"), *unique("full_date"),
        *not_null("year", "month"), between("month", 1, 12), *not_null("day_of_month"),
        between("day_of_month", 1, 31), *not_null("is_weekend"),
    )),
    "dim_posts": Suite("tests.dim_posts", "gold", False, (
        *not_null("post_sk"), *unique("post_sk"), *not_null("post_id", "user_id", "platform"),
        in_set("platform", PLATFORMS), in_set("engagement_tier", TIERS),
        between("engagement_rate_pct", 0, 100),
    )),
}

SUITES = {s.name: s for s in (
    BRONZE_TWEETS, BRONZE_ENGAGEMENTS, SILVER_TWEETS, SILVER_ENGAGEMENTS, SILVER_POSTS,
    GOLD_FACT_ENGAGEMENTS, GOLD_FACT_POST_METRICS,
)}
