"""Raw social records derived from the given tables.

The given tables are not social data. These expressions, written once in the
SQL both engines share, shape every row of them into raw posts and engagements
with the usual defects: repeated deliveries, stray case and spaces, missing
keys, negative counts, and times in several notations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .registry import Tables


def _uuid(number: str) -> str:
    return f"concat('00000000-0000-4000-8000-', lpad(cast({number} as string), 12, '0'))"


def _day(first: str, offset: str) -> str:
    return f"cast(date '{first}' + cast({offset} as int) as string)"


def _clock(hours: str) -> str:
    return f"concat(lpad(cast({hours} as string), 2, '0'), ':15:00')"


KEY_OF_PROPS = """translate(props, '{}"k: ', '')"""  # the number in {"k": 42}

# table, helper columns, how often each row is delivered, column expressions
RAW = {
    "tweets": ("documents", {}, "1 + doc_id % 3", {
        "tweet_id": f"case when doc_id % 47 = 13 then null else {_uuid('doc_id')} end",
        "user_id": "case when doc_id % 53 = 7 then null else concat('user-', cast(doc_id % 211 as string)) end",
        "platform": "case doc_id % 3 when 0 then ' Twitter ' when 1 then 'TWITTER' else 'twitter' end",
        "content": "concat('  ', text, ' ')",
        "hashtags": "case when doc_id % 6 = 0 then null else split(concat(lang, ',', source), ',') end",
        "mentions": "case when doc_id % 4 = 0 then null else split(concat('@user-', cast(doc_id % 29 as string)), ',') end",
        "language": "concat(' ', upper(lang))",
        "is_retweet": "case when doc_id % 5 = 0 then null else doc_id % 2 = 0 end",
        "is_reply": "case when doc_id % 7 = 0 then null else doc_id % 3 = 0 end",
        "media_type": "case doc_id % 4 when 0 then null when 1 then ' Photo' when 2 then 'VIDEO ' else 'gif' end",
        "likes_count": "case when doc_id % 13 = 0 then null when doc_id % 17 = 0 then 0 - n_chars else n_chars + delivery end",
        "retweets_count": "case when doc_id % 19 = 0 then null else doc_id % 97 - 5 end",
        "replies_count": "doc_id % 31 - 3",
        "impressions_count": "case when doc_id % 23 = 0 then cast(-1 as bigint) else n_chars * (doc_id % 5) end",
        "quote_count": "case when doc_id % 10 = 0 then null else doc_id % 11 end",
        "user_follower_count": "doc_id * 10",
        "user_account_type": "case doc_id % 3 when 0 then ' brand' when 1 then 'Influencer ' else 'user' end",
        "user_is_verified": "doc_id % 2 = 1",
        "created_at": "case when doc_id % 29 = 4 then 'yesterday' "
                      f"when doc_id % 4 = 0 then concat({_day('2024-01-01', 'doc_id % 30')}, 'T', {_clock('doc_id % 24')}, '+00:00') "
                      f"when doc_id % 4 = 1 then concat({_day('2024-01-01', 'doc_id % 30')}, ' ', {_clock('doc_id % 24')}) "
                      "when doc_id % 4 = 2 then cast(1704067200 + doc_id % 2500000 as string) "
                      f"else concat({_day('2024-01-01', 'doc_id % 30')}, 'T', {_clock('doc_id % 24')}, '+02:00') end",
        "ingested_at": f"concat({_day('2024-02-01', 'doc_id % 20 + delivery')}, 'T06:00:00+00:00')",
        "source_system": "'crawler'",
        "schema_version": "'1.0'",
        "batch_id": "'seed'",
    }),
    "engagements": ("events", {"k": KEY_OF_PROPS}, "1 + event_id % 2", {
        "engagement_id": f"case when event_id % 61 = 3 then null else {_uuid('event_id')} end",
        "tweet_id": "k",
        "post_id": "case when event_id % 67 = 5 then null when event_id % 10 = 0 then concat('missing-', k) else k end",
        "engaging_user_id": "case when event_id % 71 = 9 then null else concat('user-', cast(user_id as string)) end",
        "post_author_id": "concat('user-', k)",
        "platform": "case cast(k as int) % 3 when 0 then ' Twitter' when 1 then 'YOUTUBE' else 'reddit ' end",
        "engagement_type": "case when event_id % 73 = 1 then null when event_type = 'view' then 'view' "
                           "when event_type = 'click' then ' Like' when event_type = 'signup' then 'Reply ' "
                           "when event_type = 'purchase' and value >= 50 then 'QUOTE' "
                           "when event_type = 'purchase' then 'retweet' else 'clap' end",
        "content": "case when event_type = 'signup' then concat('re: ', k) end",
        "created_at": "cast(ts as string)",
        "ingested_at": "concat(cast(cast(ts as date) + cast(delivery as int) as string), 'T00:30:00+00:00')",
        "source_system": "'crawler'",
        "schema_version": "'1.0'",
        "batch_id": "'seed'",
    }),
    "videos": ("pages", {}, "1 + page_id % 2", {
        "video_id": "concat('v', cast(page_id as string))",
        "channel_id": "concat('channel-', cast(page_id % 17 as string))",
        "platform": "'YouTube'",
        "title": "url",
        "tags": "case when page_id % 5 = 0 then null else split(concat('video,tag', cast(page_id % 7 as string)), ',') end",
        "view_count": "cast(length(html) as bigint) * (page_id % 4)",
        "like_count": "page_id % 1000 - 3 + delivery",
        "comment_count": "case when page_id % 9 = 0 then null else page_id % 83 end",
        "published_at": f"concat({_day('2024-01-01', 'page_id % 30')}, 'T', {_clock('page_id % 24')}, '+00:00')",
        "ingested_at": f"concat({_day('2024-02-01', 'page_id % 20 + delivery')}, 'T07:00:00+00:00')",
        "batch_id": "'seed'",
    }),
    "reddit": ("conversations", {}, "1 + turn % 2", {
        "post_id": "concat('c', cast(conv_id as string), '-', cast(turn as string))",
        "author_user_id": "concat('user-', cast(conv_id % 211 as string))",
        "platform": "'Reddit'",
        "title": "text",
        "tags": "split(role, ',')",
        "score": "cast(length(text) as bigint) - 20 + delivery",
        "num_comments": "turn * 3",
        "subreddit": "concat('r/', role)",
        "posted_at": f"concat({_day('2024-01-01', 'conv_id % 30')}, 'T', {_clock('turn % 24')}, '+00:00')",
        "ingested_at": f"concat({_day('2024-02-01', 'conv_id % 20 + delivery')}, 'T08:00:00+00:00')",
        "batch_id": "'seed'",
    }),
}

# Already-clean shapes, one row per source row.
SHAPED = {
    "posts": ("documents", {
        "post_id": "cast(doc_id as string)",
        "user_id": "concat('user-', cast(doc_id % 211 as string))",
        "platform": "case doc_id % 3 when 0 then 'twitter' when 1 then 'youtube' else 'reddit' end",
        "content": "text",
        "hashtags": "case when doc_id % 4 = 0 then null else split(concat(lang, ',', source), ',') end",
        "posted_at": f"cast(concat({_day('2024-01-01', 'doc_id % 30')}, ' ', {_clock('doc_id % 24')}) as timestamp)",
        "likes_count": "n_chars",
        "shares_count": "case when doc_id % 8 = 0 then null else doc_id % 97 end",
        "comments_count": "doc_id % 31",
        "impressions_count": "case when doc_id % 11 = 0 then null else n_chars * (doc_id % 5) end",
        "ingested_at": f"cast(concat({_day('2024-02-01', 'doc_id % 20')}, ' 06:00:00') as timestamp)",
        "silver_batch_id": "'seed'",
    }),
    "comments": ("conversations", {
        "post_id": "concat('c', cast(conv_id as string))",
        "comment_id": "concat(cast(conv_id as string), '-', cast(turn as string))",
        "parent_comment_id": "case when turn = 0 then null else concat(cast(conv_id as string), '-', cast(turn - 1 as string)) end",
        "author_user_id": "concat('user-', role)",
        "body": "text",
        "depth": "turn",
    }),
    "users": ("events", {
        "event_id": "event_id",
        "user_id": "concat('user-', cast(user_id as string))",
        "account_type": "case when event_type = 'purchase' then 'BRAND' when event_type = 'signup' then 'INFLUENCER' else 'USER' end",
        "is_verified": "value >= 20",
        "seen_at": "cast(ts as timestamp)",
    }),
}


def delivered(source: DataFrame, name: str) -> DataFrame:
    """Rows of the source table as raw records; works on tables and streams."""
    _, helpers, times, columns = RAW[name]
    repeated = source.selectExpr("*", *[f"{e} as {c}" for c, e in helpers.items()]) \
        .selectExpr("*", f"explode(sequence(1, {times})) as delivery")
    return repeated.selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def raw(t: Tables, name: str) -> DataFrame:
    return delivered(getattr(t, RAW[name][0]), name)


def raw_sql(name: str) -> str:
    table, helpers, times, columns = RAW[name]
    shown = ", ".join(f"{e} as {c}" for c, e in columns.items())
    extra = "".join(f", {e} as {c}" for c, e in helpers.items())
    return (f"(select {shown} from (select *, unnest(range(1, 2 + {times.removeprefix('1 + ')})) as delivery "
            f"from (select *{extra} from {table}) source) repeated)")


def shaped(t: Tables, name: str) -> DataFrame:
    table, columns = SHAPED[name]
    return getattr(t, table).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def shaped_sql(name: str) -> str:
    table, columns = SHAPED[name]
    return f"(select {', '.join(f'{e} as {c}' for c, e in columns.items())} from {table})"
