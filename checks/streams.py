"""Streams over the given tables against their batch results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.sources.schemas import TOPICS
from feedforge.sources.workdir import work_dir
from feedforge.sources.writers import MAX_RECORDS_PER_FILE, RAW_CODEC
from feedforge.streaming.ingest import ANY_AGE, file_messages, is_valid, stream_ingest, validated
from feedforge.streaming.stateful import (
    drain_append, drain_update, stream_daily_counts, stream_dedup, stream_interval_join,
)

from . import sqltext as Q
from .fixtures import KEY_OF_PROPS, RAW, SHAPED, delivered, raw, raw_sql, shaped_sql
from .registry import Tables, query

# All events come, but these only after the rest has been processed. Those of them
# that the watermark has passed by then are too late; the twins leave out just these.
STRAGGLER = "event_id % 40 = 11"
DELAY = "3 days"
# Watermarks have whole milliseconds.
NEWEST_TIMELY = f"(select date_trunc('milliseconds', max(ts)) from events where not ({STRAGGLER}))"


def backlog(t: Tables) -> tuple[DataFrame, Callable[[], None]]:
    """The timely events as a stream, and a function that brings the stragglers."""
    path = work_dir(t.spark, "backlog")
    t.events.where(f"not ({STRAGGLER})").write.parquet(path)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFileAge", ANY_AGE).parquet(path)
    return stream, lambda: t.events.where(STRAGGLER).write.mode("append").parquet(path)


def table_stream(t: Tables, name: str) -> DataFrame:
    """A given table, a file or a folder of files, as a stream of rows.

    The path is a pattern: Spark takes a plain path of a stream for a folder.
    """
    return t.spark.readStream.schema(getattr(t, name).schema) \
        .option("maxFileAge", ANY_AGE).parquet(f"{t.folder}/{name}[.]parquet")


def topic_log(t: Tables) -> str:
    """Raw tweets and engagements as messages of their topics."""
    path = work_dir(t.spark, "topics")
    for topic, name in zip(TOPICS, ("tweets", "engagements")):
        raw(t, name).select(F.lit(topic.name).alias("topic"),
                            F.to_json(F.struct("*")).alias("value")) \
            .write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE) \
            .option("compression", RAW_CODEC).json(path)
    return path


_REQUIRED = {
    "tweets": ("tweet_id", "user_id", "platform", "created_at"),
    "engagements": ("engagement_id", "post_id", "engaging_user_id", "engagement_type"),
}


def _missing(name: str) -> str:
    return " or ".join(f"{c} is null" for c in _REQUIRED[name])


def _ingested(t: Tables) -> str:
    bronze = work_dir(t.spark, "bronze")
    stream, _ = stream_ingest(file_messages(t.spark, topic_log(t)), bronze,
                              work_dir(t.spark, "ingest-checkpoint"), str(uuid.uuid4()), drain=True)
    stream.awaitTermination()
    return bronze


@query("stream_ingest", f"""
    select engagement_id, post_id, engaging_user_id, engagement_type, created_at, ingested_at
    from {raw_sql('engagements')} r where not ({_missing('engagements')})""")
def _(t):
    return t.spark.read.schema(
        "engagement_id string, post_id string, engaging_user_id string, engagement_type string, "
        "created_at string, ingested_at string").json(f"{_ingested(t)}/{TOPICS[1].path}") \
        .select("engagement_id", "post_id", "engaging_user_id", "engagement_type", "created_at", "ingested_at")


@query("stream_route", " union all ".join(
    f"""select '{topic.name}' as topic, count(*) filter (where not ({_missing(name)})) as delivered,
      count(*) filter (where {_missing(name)}) as dead_letters from {raw_sql(name)} r"""
    for topic, name in zip(TOPICS, ("tweets", "engagements"))))
def _(t):
    bronze = _ingested(t)

    def counted(path: str, topic: str, column: str, other: str) -> DataFrame:
        rows = t.spark.read.schema("ingested_at string").json(path).agg(F.count(F.lit(1)).alias(column))
        return rows.select(F.lit(topic).alias("topic"), column, F.lit(0).cast("bigint").alias(other))

    parts = []
    for topic in TOPICS:
        parts.append(counted(f"{bronze}/{topic.path}", topic.name, "delivered", "dead_letters"))
        parts.append(counted(f"{bronze}/_dead_letters/{topic.path}", topic.name, "dead_letters", "delivered"))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return merged.groupBy("topic").agg(F.sum("delivered").alias("delivered"),
                                       F.sum("dead_letters").alias("dead_letters"))


@query("stream_validate", f"""
    select engagement_id, post_id, 'run-1' as batch_id, ingested_at from {raw_sql('engagements')} r
    where not ({_missing('engagements')})""")
def _(t):
    records = delivered(table_stream(t, RAW["engagements"][0]), "engagements")
    kept = validated(records, "twitter.engagements", "run-1").filter(is_valid())
    return drain_append(kept.select("engagement_id", "post_id", "batch_id", "ingested_at"), "validated")


@query("stream_dedup", f"""
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type from events
    where not ({STRAGGLER}) or ts > {NEWEST_TIMELY} - interval {DELAY}""")
def _(t):
    events, stragglers = backlog(t)
    repeated = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "explode(sequence(1, 1 + event_id % 3)) as delivery")
    return drain_append(stream_dedup(repeated.drop("delivery"), ["event_id"], "ts", DELAY), "dedup", stragglers)


# A day is open until the watermark has passed its end.
@query("stream_daily_counts", f"""
    select cast(cast(ts as date) as varchar) as day, event_type, count(*) as n_events from events
    where not ({STRAGGLER}) or date_trunc('day', ts) + interval 1 day > {NEWEST_TIMELY} - interval {DELAY}
    group by 1, 2""")
def _(t):
    events, stragglers = backlog(t)
    counts = stream_daily_counts(events, ["event_type"], "ts", DELAY)
    return drain_update(counts, "daily-counts", ["day", "event_type"], stragglers)


# The watermark of two streams is that of the slower one.
_PAIRS = f"""
    select p.post_id, e.event_id, e.event_type
    from {shaped_sql('posts')} p
    join (select event_id, event_type, ts, {KEY_OF_PROPS} as post_id from events
          where not ({STRAGGLER})
            or ts > least({NEWEST_TIMELY}, (select max(posted_at) from {shaped_sql('posts')})) - interval {DELAY}) e
      on e.post_id = p.post_id and e.ts > p.posted_at and e.ts <= p.posted_at + interval 24 hour"""


def _followed(t: Tables, unanswered: bool = False) -> DataFrame:
    columns = SHAPED["posts"][1]
    posts = table_stream(t, "documents").selectExpr(
        f"{columns['post_id']} as post_id", f"{columns['posted_at']} as posted_at")
    events, stragglers = backlog(t)
    engaged = events.selectExpr("event_id", "event_type", "ts", f"{KEY_OF_PROPS} as post_id")
    pairs = stream_interval_join(posts, engaged, ["post_id"], "posted_at", "ts", delay=DELAY, unanswered=unanswered)
    return drain_append(pairs.select("post_id", "event_id", "event_type"), "pairs", stragglers)


@query("stream_interval_join", _PAIRS)
def _(t):
    return _followed(t)


# Posts whose window the watermark has passed in the end, and which nothing followed in it.
@query("stream_unanswered_posts", f"""
    with pairs as ({_PAIRS})
    select post_id, event_id, event_type from pairs
    union all
    select p.post_id, null, null from {shaped_sql('posts')} p
    where p.post_id not in (select post_id from pairs) and p.posted_at + interval 24 hour
      < least((select max(ts) from events), (select max(posted_at) from {shaped_sql('posts')})) - interval {DELAY}""")
def _(t):
    return _followed(t, unanswered=True)
