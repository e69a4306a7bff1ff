"""Validation, cleaning, dedup and the Silver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedforge.functions import columns as C
from feedforge.operators.cleaning import normalize_ts, reject_split, tag_metadata, validate_required
from feedforge.operators.dedup import dedup_latest
from feedforge.plans import silver
from feedforge.sources.schemas import CLEAN_KEYS

from . import sqltext as Q
from .fixtures import raw, raw_sql
from .registry import Tables, query


def tweets(t: Tables):
    return silver.clean_tweets(raw(t, "tweets"), Q.BATCH)


def engagements(t: Tables):
    return silver.clean_engagements(raw(t, "engagements"), Q.BATCH)


def _missing(*names: str) -> str:
    cases = ", ".join(
        f"case when {n} is null then 'Required field missing or null: {n}' end" for n in names)
    return f"list_filter([{cases}], lambda x: x is not null)"


_TWEET_ERRORS = _missing("tweet_id", "user_id", "platform", "created_at")


@query("validate_required", f"""
    select user_id, created_at, ingested_at, array_to_string({_TWEET_ERRORS}, ',') as errors,
      len({_TWEET_ERRORS}) = 0 as is_valid from {raw_sql('tweets')} r""")
def _(t):
    checked = validate_required(raw(t, "tweets"), "twitter.tweets")
    return checked.select("user_id", "created_at", "ingested_at", "errors",
                          (F.size("errors") == 0).alias("is_valid"))


@query("reject_split", f"""
    select engagement_id, post_id, engaging_user_id, engagement_type, created_at, ingested_at
    from {raw_sql('engagements')} r where engagement_id is null or post_id is null
      or engaging_user_id is null or engagement_type is null""")
def _(t):
    _, rejected = reject_split(raw(t, "engagements"), CLEAN_KEYS["twitter.engagements"])
    return rejected.select("engagement_id", "post_id", "engaging_user_id", "engagement_type",
                           "created_at", "ingested_at")


@query("tag_metadata", f"""
    select tweet_id, 'run-1' as batch_id, 'landing/a.json' as source_file,
      case when user_id is null then '2024-03-01T00:00:00.000000Z' else ingested_at end as ingested_at
    from {raw_sql('tweets')} r""")
def _(t):
    some_untimed = raw(t, "tweets").withColumn(
        "ingested_at", F.when(F.col("user_id").isNotNull(), F.col("ingested_at")))
    return tag_metadata(some_untimed, "run-1", "landing/a.json", F.lit("2024-03-01").cast("timestamp")) \
        .select("tweet_id", "batch_id", "source_file", "ingested_at")


@query("normalize_ts", f"""
    select created_at as raw_text, {Q.stamp(Q.parsed('created_at'))} as created_at, count(*) as n
    from {raw_sql('tweets')} r group by all""")
def _(t):
    timed = normalize_ts(raw(t, "tweets").withColumn("raw_text", F.col("created_at")),
                         ("created_at", "not_a_column"))
    return timed.groupBy("raw_text", "created_at").agg(F.count(F.lit(1)).alias("n"))


@query("engagement_type_norm", f"""
    select engagement_type as raw_type, {Q.TYPE_FOLD} as engagement_type, count(*) as n
    from {raw_sql('engagements')} r group by 1, 2""")
def _(t):
    return raw(t, "engagements").groupBy(
        F.col("engagement_type").alias("raw_type"),
        C.engagement_type("engagement_type").alias("engagement_type"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("engagement_weight", f"""
    select kind, {Q.WEIGHT.format('kind')} as weight, count(*) as n
    from (select {Q.TYPE_FOLD} as kind from {raw_sql('engagements')} r) x group by 1, 2""")
def _(t):
    typed = raw(t, "engagements").select(C.engagement_type("engagement_type").alias("kind"))
    return typed.groupBy("kind", C.engagement_weight("kind").alias("weight")).agg(
        F.count(F.lit(1)).alias("n"))


_LINE_REST = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus")
_LINE_SQL = ("select * replace (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') as l_shipdate) from lineitem "
             "qualify row_number() over (partition by l_orderkey, l_linenumber order by {}) = 1")


@query("dedup_latest", _LINE_SQL.format(
    ", ".join(f"{c} desc nulls last" for c in ("lineitem.l_shipdate", *_LINE_REST))))
def _(t):
    return dedup_latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", _LINE_REST)


@query("dedup_earliest", _LINE_SQL.format(
    ", ".join(f"{c} asc nulls first" for c in ("lineitem.l_shipdate", *_LINE_REST))))
def _(t):
    return dedup_latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", _LINE_REST, desc=False)


@query("clean_tweets", f"""
    select * replace (array_to_string(hashtags, ',') as hashtags, array_to_string(mentions, ',') as mentions,
      {Q.stamp('created_at')} as created_at, {Q.stamp('ingested_at')} as ingested_at)
    from {Q.CLEAN_TWEETS} t""")
def _(t):
    return tweets(t).drop("silver_processed_at")


@query("clean_engagements", f"""
    select * replace ({Q.stamp('created_at')} as created_at, {Q.stamp('ingested_at')} as ingested_at)
    from {Q.CLEAN_ENGAGEMENTS} t""")
def _(t):
    return engagements(t).drop("silver_processed_at")


_UNIFIED = """select * replace (md5(content) as content, array_to_string(hashtags, ',') as hashtags,
    {} as posted_at, {} as ingested_at) from {} u"""


def _unified(t: Tables, clean: bool):
    return silver.posts_unified(tweets(t), raw(t, "videos"), raw(t, "reddit"), Q.BATCH, clean=clean) \
        .withColumn("content", F.md5("content"))


@query("posts_unified", _UNIFIED.format(Q.stamp("posted_at"), Q.stamp("ingested_at"), Q.unified()))
def _(t):
    return _unified(t, clean=False)


@query("posts_unified_clean", _UNIFIED.format(Q.stamp("posted_at"), Q.stamp("ingested_at"), Q.unified(True)))
def _(t):
    return _unified(t, clean=True)
