"""Raw record layouts and where they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Field names, types and order of the raw records.
_LAYOUTS = {
    "twitter.tweets": """
        tweet_id string, user_id string, platform string,
        content string, hashtags array<string>, mentions array<string>, language string,
        is_retweet boolean, is_reply boolean, media_type string,
        likes_count bigint, retweets_count bigint, replies_count bigint,
        impressions_count bigint, quote_count bigint,
        user_follower_count bigint, user_account_type string, user_is_verified boolean,
        created_at string, ingested_at string, source_system string, schema_version string
    """,
    "twitter.engagements": """
        engagement_id string, tweet_id string, post_id string, engaging_user_id string,
        post_author_id string, platform string, engagement_type string, content string,
        created_at string, ingested_at string, source_system string, schema_version string
    """,
    "youtube.videos": """
        video_id string, channel_id string, platform string,
        title string, description string, category string, tags array<string>, language string,
        duration_seconds int, thumbnail_url string, is_short boolean, is_live_stream boolean,
        age_restricted boolean, view_count bigint, like_count bigint, dislike_count bigint,
        comment_count bigint, share_count bigint, subscriber_gain bigint, channel_name string,
        channel_subscriber_count bigint, channel_account_type string,
        published_at string, ingested_at string, source_system string, schema_version string
    """,
    "youtube.comments": """
        comment_id string, video_id string, parent_comment_id string, author_user_id string,
        author_username string, platform string, content string, is_reply boolean,
        is_pinned boolean, is_hearted boolean, like_count bigint,
        published_at string, ingested_at string, source_system string, schema_version string
    """,
    "youtube.snapshots": """
        snapshot_id string, video_id string, snapshot_date string, daily_views bigint,
        cumulative_views bigint, daily_likes bigint, daily_comments bigint,
        ingested_at string, source_system string
    """,
    "reddit.posts": """
        post_id string, author_user_id string, author_username string, subreddit string,
        subreddit_category string, platform string, title string, body string, url string,
        post_type string, flair string, tags array<string>, is_nsfw boolean, is_spoiler boolean,
        is_oc boolean, is_crosspost boolean, score bigint, upvotes bigint, downvotes bigint,
        upvote_ratio double, num_comments bigint, num_awards bigint, is_pinned boolean,
        author_karma bigint, author_account_age_days bigint,
        posted_at string, ingested_at string, source_system string, schema_version string
    """,
    "reddit.comments": """
        comment_id string, post_id string, parent_comment_id string, author_user_id string,
        author_username string, subreddit string, platform string, body string, depth int,
        is_edited boolean, is_deleted boolean, is_mod_comment boolean, contains_url boolean,
        score bigint, upvotes bigint, downvotes bigint, num_awards bigint,
        posted_at string, ingested_at string, source_system string, schema_version string
    """,
}

# Fields that must be present and non-null, per raw entity.
REQUIRED = {
    "twitter.tweets": ("tweet_id", "user_id", "platform", "created_at"),
    "twitter.engagements": ("engagement_id", "post_id", "engaging_user_id", "engagement_type"),
    "youtube.videos": ("video_id", "channel_id", "platform", "published_at"),
    "youtube.comments": ("comment_id", "video_id", "author_user_id"),
    "youtube.snapshots": ("snapshot_id", "video_id", "snapshot_date"),
    "reddit.posts": ("post_id", "author_user_id", "subreddit", "posted_at"),
    "reddit.comments": ("comment_id", "post_id", "author_user_id"),
}

# Keys a cleaned record cannot do without.
CLEAN_KEYS = {
    "twitter.tweets": ("tweet_id", "user_id"),
    "twitter.engagements": ("engagement_id", "post_id", "engaging_user_id", "engagement_type"),
}

# The columns the unified posts table reads from the other platforms.
NARROW = {
    "youtube.videos": (
        "video_id", "channel_id", "platform", "title", "tags", "view_count", "like_count",
        "comment_count", "published_at", "ingested_at",
    ),
    "reddit.posts": (
        "post_id", "author_user_id", "platform", "title", "tags", "score", "num_comments",
        "posted_at", "ingested_at",
    ),
}

LINEAGE = ("batch_id", "source_file")

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def raw_schema(entity: str, only: tuple[str, ...] | None = None, lineage: bool = False) -> T.StructType:
    """Read schema of a raw entity; ``only`` narrows it at the source."""
    pairs = [part.split() for part in _LAYOUTS[entity].split(",")]
    fields = [T.StructField(name, _TYPES[kind], True) for name, kind in pairs
              if only is None or name in only]
    if lineage:
        fields += [T.StructField(name, T.StringType(), True) for name in LINEAGE]
    return T.StructType(fields)


@dataclass(frozen=True)
class LandingSource:
    """A landing folder and the raw entity its files hold."""

    prefix: str
    source: str
    entity: str
    schema_key: str | None

    @property
    def path(self) -> str:
        return f"{self.source}/{self.entity}"


@dataclass(frozen=True)
class Topic:
    """An event topic and the raw entity its messages hold."""

    name: str
    source: str
    entity: str

    @property
    def schema_key(self) -> str:
        return f"{self.source}.{self.entity}"

    @property
    def path(self) -> str:
        return f"{self.source}/{self.entity}"


# Landing folders (reference data has no schema) and event topics.
LANDING = (
    LandingSource("youtube/videos/", "youtube", "videos", "youtube.videos"),
    LandingSource("youtube/comments/", "youtube", "comments", "youtube.comments"),
    LandingSource("youtube/snapshots/", "youtube", "snapshots", "youtube.snapshots"),
    LandingSource("reddit/posts/", "reddit", "posts", "reddit.posts"),
    LandingSource("reddit/comments/", "reddit", "comments", "reddit.comments"),
    LandingSource("reddit/metadata/", "reddit", "subreddits", None),
)
TOPICS = (
    Topic("social.tweets", "twitter", "tweets"),
    Topic("social.engagements", "twitter", "engagements"),
)
DEAD_LETTER_TOPIC = "social.events.dlq"
