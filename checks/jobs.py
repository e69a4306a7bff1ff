"""The jobs as a whole, from Bronze folders to reports, on repeated deliveries.

Bronze holds every raw record below its day, some of them twice on that day. All
days are processed, then one day of tweets is delivered anew without a single
valid row and processed again. Gold and the reports follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedforge.functions.columns import utc_timestamp
from feedforge.plans.jobs import build_gold, build_marts, run_silver
from feedforge.sources.readers import read_table
from feedforge.sources.workdir import work_dir
from feedforge.sources.writers import RAW_CODEC, write_raw

from . import sqltext as Q
from .fixtures import raw, raw_sql
from .registry import Tables, query

FIRST, LAST, EMPTIED = "2024-01-01", "2024-03-15", "2024-02-10"
BRONZE = {"tweets": "twitter/tweets", "engagements": "twitter/engagements", "videos": "youtube/videos", "reddit": "reddit/posts"}
IDS = {"tweets": "tweet_id", "engagements": "engagement_id", "videos": "video_id", "reddit": "post_id"}
DONE: dict[tuple[str, str], str] = {}
REPORTED: set[str] = set()


def ran_silver(t: Tables) -> str:
    """The folder in which both runs up to Silver are done; they run once for an application and table folder."""
    known = (t.spark.sparkContext.applicationId, t.folder)
    if known not in DONE:
        root = work_dir(t.spark, "jobs")
        for name, path in BRONZE.items():
            rows = raw(t, name)
            twice = rows.where(F.col(IDS[name]).endswith("5"))
            write_raw(rows.union(twice), f"{root}/bronze/{path}", codec=RAW_CODEC)
        folders = (t.spark, f"{root}/bronze", f"{root}/silver")
        run_silver(*folders, FIRST, LAST, check=False, quarantine=f"{root}/quarantine")
        lost = raw(t, "tweets").where(F.to_date(utc_timestamp("ingested_at")) == EMPTIED)
        write_raw(lost.withColumn("user_id", F.lit(None).cast("string")), f"{root}/bronze/{BRONZE['tweets']}", mode="overwrite",
                  codec=RAW_CODEC)
        run_silver(*folders, EMPTIED, check=False, quarantine=f"{root}/quarantine")
        DONE[known] = root
    return DONE[known]


def ran(t: Tables) -> str:
    """The folder in which the jobs ran to their end; Gold and the reports follow Silver once, when first read."""
    root = ran_silver(t)
    if root not in REPORTED:
        build_gold(t.spark, f"{root}/silver", f"{root}/gold", check=False)
        build_marts(t.spark, f"{root}/silver", f"{root}/gold", f"{root}/marts")
        REPORTED.add(root)
    return root


def _day(c: str = "ingested_at") -> str:
    return f"cast({Q.parsed(c)} as date)"


def _bronze(name: str) -> str:
    """Raw records with their day, some twice, and whether they lack a key."""
    lacking = {"tweets": "tweet_id is null or user_id is null",
               "engagements": "engagement_id is null or post_id is null or engaging_user_id is null or engagement_type is null"}
    rows = f"select *, {_day()} as came, {lacking.get(name, 'false')} as bad from {raw_sql(name)} r"
    return f"({rows} union all {rows} where {IDS[name]} like '%5')"


def _counts(name: str, only: str = "true") -> str:
    return (f"(select count(*) as n_read, count(*) filter (where bad) as n_bad, "
            f"count(distinct ({IDS[name]}, came)) filter (where not bad) as n_kept from {_bronze(name)} b where {only})")


_ONE_DAY = f"came = date '{EMPTIED}'"
_LOST = f"(select count(*) as n from {raw_sql('tweets')} r where {_day()} = date '{EMPTIED}')"


@query("job_ledger", f"""
    with tw as {_counts('tweets')}, en as {_counts('engagements')}, vi as {_counts('videos')}, re as {_counts('reddit')},
      lost as {_LOST}, vi2 as {_counts('videos', _ONE_DAY)}, re2 as {_counts('reddit', _ONE_DAY)}, en2 as {_counts('engagements', _ONE_DAY)},
      rows as (
        select 1 as run, 'tweets' as entity, n_read as records_read, n_bad as records_rejected, n_kept as records_kept from tw
        union all select 1, 'engagements', n_read, n_bad, n_kept from en
        union all select 1, 'posts', tw.n_kept + vi.n_read + re.n_read, 0, tw.n_kept + vi.n_kept + re.n_kept from tw, vi, re
        union all select 2, 'tweets', n, n, 0 from lost
        union all select 2, 'engagements', n_read, n_bad, n_kept from en2
        union all select 2, 'posts', vi2.n_read + re2.n_read, 0, vi2.n_kept + re2.n_kept from vi2, re2)
    select run, entity, records_read, records_rejected, records_read - records_rejected - records_kept as duplicates_removed,
      records_kept, true as has_files from rows""")
def _(t):
    ledger = read_table(t.spark, f"{ran_silver(t)}/silver/ledger")
    runs = ledger.withColumn("run", F.dense_rank().over(Window.partitionBy("entity").orderBy("started_at")))
    return runs.select("run", "entity", "records_read", "records_rejected", "duplicates_removed", "records_kept",
                       ((F.col("files_processed") > 0) | (F.col("records_read") == 0)).alias("has_files"))


_STAYED = f"came <> date '{EMPTIED}'"
_PER_DAY = "year(came) as year, month(came) as month, day(came) as day"


@query("job_silver_days", f"""
    select 'tweets' as table_name, {_PER_DAY}, count(distinct tweet_id) as n_rows
      from {_bronze('tweets')} b where not bad and {_STAYED} group by came
    union all select 'engagements', {_PER_DAY}, count(distinct engagement_id) from {_bronze('engagements')} b where not bad group by came
    union all select 'posts', {_PER_DAY}, count(*) from (
      select distinct tweet_id as id, 'twitter' as platform, came from {_bronze('tweets')} b where not bad and {_STAYED}
      union all select distinct video_id, 'youtube', came from {_bronze('videos')} v
      union all select distinct post_id, 'reddit', came from {_bronze('reddit')} p) u group by came
    union all select 'rejected tweets', {_PER_DAY}, count(*) from (
      select came from {_bronze('tweets')} b where bad and {_STAYED}
      union all select {_day()} from {raw_sql('tweets')} r where {_day()} = date '{EMPTIED}') q group by came
    union all select 'rejected engagements', {_PER_DAY}, count(*) from {_bronze('engagements')} b where bad group by came""")
def _(t):
    root = ran_silver(t)
    tables = {**{n: f"silver/{n}" for n in ("tweets", "engagements", "posts")},
              **{f"rejected {n}": f"quarantine/twitter/{n}" for n in ("tweets", "engagements")}}
    return reduce(DataFrame.union, [
        read_table(t.spark, f"{root}/{path}").groupBy(F.lit(name).alias("table_name"), "year", "month", "day")
        .agg(F.count(F.lit(1)).alias("n_rows")) for name, path in tables.items()])


# Tweets as Silver has them after both runs, once per delivery day.
_TWEETS = f"""(select distinct tweet_id, user_id, user_follower_count as follower_count,
    upper(trim(user_account_type)) as account_type, user_is_verified as is_verified, mentions,
    {Q.parsed('created_at')} as created_at, {Q.parsed('ingested_at')} as ingested_at
  from {_bronze('tweets')} b where not bad and {_STAYED})"""
_STATE = ("follower_count", "account_type", "is_verified")


@query("gold_dim_users", f"""
    with days as (
      select user_id, cast(created_at as date) as day, {', '.join(_STATE)} from {_TWEETS} t
      qualify row_number() over (partition by user_id, cast(created_at as date)
        order by created_at desc nulls last, ingested_at desc, tweet_id desc) = 1),
    changes as (
      select *, row_number() over w as n, lag(({', '.join(_STATE)})) over w as before from days
      window w as (partition by user_id order by day nulls first))
    select {Q.key('user_id', 'day')} as user_sk, user_id, 'twitter' as platform, follower_count, account_type,
      account_type = 'BRAND' as is_brand, is_verified, day as valid_from,
      lead(day) over v as valid_to, lead(day) over v is null as is_current
    from changes where n = 1 or before is distinct from ({', '.join(_STATE)})
    window v as (partition by user_id order by day nulls first)""")
def _(t):
    return read_table(t.spark, f"{ran(t)}/gold/dim_users")


@query("marts_share_of_voice", f"""
    with told as (select tweet_id, unnest(any_value(mentions)) as brand from {_TWEETS} t where mentions is not null group by tweet_id),
      counted as (select brand, count(*) as mentions from told group by brand)
    select 'twitter' as platform, brand, mentions, sum(mentions) over ()::bigint as platform_mentions,
      round(mentions * 100.0 / sum(mentions) over (), 4)::double as share_pct from counted""")
def _(t):
    return read_table(t.spark, f"{ran(t)}/marts/share_of_voice")


@query("marts_daily_active_users", f"""
    select cast({Q.parsed('created_at')} as date) as activity_date, count(distinct engaging_user_id) as active_users,
      count(distinct engagement_id) as n_events
    from {_bronze('engagements')} b where not bad group by 1""")
def _(t):
    return read_table(t.spark, f"{ran(t)}/marts/daily_active_users")
