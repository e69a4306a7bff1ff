"""End-to-end runs over folders: Bronze -> Silver -> Gold."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedforge.functions.columns import any_null
from feedforge.operators import suites
from feedforge.operators.cleaning import reject_split
from feedforge.operators.calendar import dim_date
from feedforge.operators.dedup import dedup_latest
from feedforge.operators.quality import KEYED, Suite, enforce_all, enforce_completeness
from feedforge.operators.runs import layer_ledger, run_summary
from feedforge.session import pin_utc
from feedforge.sources.readers import (
    DAY_COLUMNS, check_range, days_between, days_of, read_raw_days, read_table,
)
from feedforge.sources.schemas import CLEAN_KEYS, NARROW
from feedforge.sources.workdir import work_dir
from feedforge.sources.snapshots import in_days, publish, read_snapshot
from feedforge.sources.writers import replace_table

from . import gold, marts, silver

JOB = "bronze_to_silver"
FACT_PARTS = ("date_sk",)


def run_silver(spark: SparkSession, bronze: str, target: str, start: date | str | None = None,
               end: date | str | None = None, check: bool = True,
               quarantine: str | None = None, quality: str | None = None,
               least_complete: float = 0.8) -> DataFrame:
    """Process the raw days ``start..end`` (default: yesterday) into Silver.

    Days are read in one plan but deduplicated each by itself, and a table's days of
    the range are replaced in one commit: a day that has no valid row any more is
    empty afterwards, days outside of the range stay. So a range gives what single
    days would give, a rerun changes nothing, and a rerun after a repair leaves
    nothing of before. The partition is the day of the raw folder, so a run cannot
    touch a day it did not read. With ``quarantine``, rows without their keys are
    kept in a folder of that name, per entity and day, and replaced alike. Read
    the tables with ``read_table``.

    Every entity is processed on its own data, so a day without tweets still gets
    its engagements and posts; a range without any raw row is left alone. The
    Silver suites of all entities that had raw rows block; their outcomes are
    appended to the folder ``quality`` before they do. A run also blocks if less
    than ``least_complete`` of an entity's records, repeated deliveries aside, were
    kept. Returns one row that sums the run up, and appends one per entity to
    ``target/ledger``: rows kept are exact, rows read and rejected are counted at
    the scan and may include rows of a task that had to be repeated.
    """
    pin_utc(spark)
    yesterday = datetime.now(timezone.utc).date() - timedelta(days=1)
    first, last = check_range(start or yesterday, end or start or yesterday)
    covered = in_days(first, last)
    run_id, began = str(uuid.uuid4()), datetime.now(timezone.utc)
    raw = {
        name: read_raw_days(spark, f"{bronze}/{name.replace('.', '/')}", name, first, last,
                            only=NARROW.get(name), lineage=name.startswith("twitter"))
        for name in ("twitter.tweets", "twitter.engagements", "youtube.videos", "reddit.posts")
    }
    if all(df.isEmpty() for df in raw.values()):
        return run_summary(spark, run_id, JOB, "silver", began, 0, 0, 0, 0)
    found = {name: df.inputFiles() for name, df in raw.items()}
    files = {name: len(paths) for name, paths in found.items()}
    if quarantine:
        for name, keys in CLEAN_KEYS.items():
            _, rejected = reject_split(raw[name], keys)
            publish(rejected, f"{quarantine}/{name.replace('.', '/')}", DAY_COLUMNS, covered)
    seen: dict[str, list[Observation]] = {name: [] for name in raw}

    def of_day(name: str, day: date) -> DataFrame:
        seen[name].append(Observation())
        return raw[name].filter(days_between(day, day)).withColumn("_day", F.make_date(*DAY_COLUMNS)).observe(
            seen[name][-1], F.count(F.lit(1)).alias("read"),
            F.count_if(any_null(CLEAN_KEYS.get(name, ()))).alias("rejected"))

    def day_by_day(latest: Callable[..., DataFrame], *names: str) -> DataFrame:
        """One plan with a branch per day: the shuffle of its dedup leaves each day in
        tasks of its own, as it is written, and no second one has to gather the days.

        A union of branches that are partitioned by the same columns would be one task
        for a partition of all of them; so they are by a column that is then dropped.
        """
        days = days_of({p for n in names for p in found[n]}) or [first]
        return reduce(DataFrame.unionByName, [
            latest(*[of_day(n, d) for n in names], within=(*DAY_COLUMNS, "_day")).drop("_day") for d in days])

    def store(df: DataFrame, entity: str) -> int:
        return publish(df, f"{target}/{entity}", DAY_COLUMNS, covered)

    def stored(entity: str) -> DataFrame:
        return read_snapshot(spark, f"{target}/{entity}", where=covered)

    tweets = day_by_day(silver.latest_tweets, "twitter.tweets")
    kept = {"tweets": store(silver.tidy_tweets(tweets, run_id), "tweets")}
    engaged = day_by_day(silver.latest_engagements, "twitter.engagements")
    kept["engagements"] = store(silver.tidy_engagements(engaged, run_id), "engagements")
    # The tweets are read back as written, by day, rather than cleaned a second time.
    tweets = stored("tweets")
    others = day_by_day(partial(silver.posts_of_other_platforms, batch_id=run_id), "youtube.videos", "reddit.posts")
    kept["posts"] = store(silver.posts_from_tweets(tweets, DAY_COLUMNS).unionByName(others), "posts")
    read, rejected = ({name: sum(o.get[of] for o in by_day) for name, by_day in seen.items()} for of in ("read", "rejected"))
    ledger = layer_ledger(spark, run_id, began, [
        ("tweets", read["twitter.tweets"], rejected["twitter.tweets"], kept["tweets"], files["twitter.tweets"]),
        ("engagements", read["twitter.engagements"], rejected["twitter.engagements"], kept["engagements"],
         files["twitter.engagements"]),
        # Posts are made of the kept tweets and of all videos and forum posts.
        ("posts", kept["tweets"] + read["youtube.videos"] + read["reddit.posts"], 0, kept["posts"],
         files["youtube.videos"] + files["reddit.posts"]),
    ])
    publish(ledger, f"{target}/ledger", append=True)
    if check:
        pairs = []
        if read["twitter.tweets"]:
            pairs += _per_day((suites.QUICK_SILVER_TWEETS, suites.SILVER_TWEETS), tweets, "tweet_id")
        if read["twitter.engagements"]:
            pairs += _per_day((suites.SILVER_ENGAGEMENTS,), stored("engagements"), "engagement_id")
        if any(read[n] for n in ("twitter.tweets", "youtube.videos", "reddit.posts")):
            pairs.append((stored("posts"), suites.SILVER_POSTS))
        enforce_all(pairs, quality, run_id)
        enforce_completeness(ledger, least_complete)
    return run_summary(spark, run_id, JOB, "silver", began, read=sum(read.values()), written=sum(kept.values()),
                       rejected=sum(rejected.values()), files=sum(files.values()))


def _per_day(of: tuple[Suite, ...], df: DataFrame, key: str) -> list[tuple[DataFrame, Suite]]:
    """Suites with their key unique per day: a record may come again on another day."""
    daily = f"{key}_and_day"
    keyed = df.withColumn(daily, F.struct(key, *DAY_COLUMNS))

    def renamed(suite: Suite) -> Suite:
        return replace(suite, rules=tuple(
            replace(r, column=daily) if r.kind in KEYED and r.column == key else r for r in suite.rules))

    return [(keyed, renamed(suite)) for suite in of]


def build_gold(spark: SparkSession, silver_root: str, target: str, check: bool = True,
               quality: str | None = None) -> None:
    """Rebuild every Gold table from Silver.

    Each table is replaced in one commit, written last: a run that is lost leaves
    the tables it did not come to as they were, and readers never see half a
    table. The facts are partitioned by date. Read the tables with ``read_table``.

    ``quality`` is a folder to which the outcomes of the suites are appended.

    Silver keeps a record once per day it was delivered; Gold takes the latest.
    Enriched posts feed three tables; they are written once, as ``dim_posts``
    needs most of their columns anyway, and read back narrow by the facts. The
    staged engagements are read by two facts and written once for the same
    reason.
    """
    pin_utc(spark)
    # Cut to the preview before the shuffle.
    latest_posts = dedup_latest(gold.previewed(read_table(spark, f"{silver_root}/posts")), gold.POST_KEY)
    posts = gold.posts_enriched(gold.stg_posts(latest_posts))
    latest = dedup_latest(read_table(spark, f"{silver_root}/engagements"), ["engagement_id"])
    staging = work_dir(spark, "staged-engagements")
    replace_table(gold.stg_engagements(latest), staging)
    engagements = read_table(spark, staging)
    publish(dim_date(spark), f"{target}/dim_date")
    publish(gold.dim_posts(posts), f"{target}/dim_posts")
    enriched = read_table(spark, f"{target}/dim_posts")
    publish(gold.dim_platforms(enriched), f"{target}/dim_platforms")
    bridge = gold.post_hashtags(enriched)
    publish(bridge, f"{target}/post_hashtags")
    publish(gold.dim_hashtags(read_table(spark, f"{target}/post_hashtags")), f"{target}/dim_hashtags")
    publish(marts.dim_users_of_tweets(read_table(spark, f"{silver_root}/tweets")), f"{target}/dim_users")
    facts = gold.fact_with_keys(
        gold.fact_engagements(engagements, enriched), read_table(spark, f"{target}/dim_users"),
        read_table(spark, f"{target}/dim_platforms"), engagements)
    publish(facts, f"{target}/fact_engagements", FACT_PARTS, rebalance=True)
    daily = gold.daily_engagements(engagements)
    publish(gold.fact_post_metrics(enriched, daily), f"{target}/fact_post_metrics", FACT_PARTS, rebalance=True)
    if check:
        enforce_all([
            (read_table(spark, f"{target}/fact_engagements"), suites.GOLD_FACT_ENGAGEMENTS),
            (read_table(spark, f"{target}/fact_post_metrics"), suites.GOLD_FACT_POST_METRICS),
        ], quality, str(uuid.uuid4()))


def build_marts(spark: SparkSession, silver_root: str, gold_root: str, target: str,
                top_tags: int = 20, top_posts: int = 100) -> None:
    """Rebuild the reports from Silver and Gold."""
    pin_utc(spark)
    facts = read_table(spark, f"{gold_root}/fact_engagements")
    posts = read_table(spark, f"{gold_root}/dim_posts")
    tweets = read_table(spark, f"{silver_root}/tweets")
    daily_path = f"{target}/daily_engagements"
    publish(gold.daily_engagements(facts, "engagement_timestamp"), daily_path)
    daily = read_table(spark, daily_path)  # read by three reports
    staging = work_dir(spark, "tag-days")  # read for its last day and for the sums
    replace_table(marts.tag_days_of_posts(daily, read_table(spark, f"{gold_root}/post_hashtags")), staging)
    tag_days = read_table(spark, staging)
    # Silver keeps a tweet once per delivery day; it mentions a brand once.
    delivered = tweets.select("tweet_id", "platform", "mentions", "ingested_at")
    mentions = dedup_latest(delivered, ["tweet_id"]).select("platform", F.explode("mentions").alias("brand"))
    calendar = read_table(spark, f"{gold_root}/dim_date")
    tables = {
        "daily_active_users": marts.daily_active_users(facts, "engaging_user_id", "engagement_timestamp"),
        "post_reach": marts.post_reach(facts, list(gold.POST_KEY), "engaging_user_id"),
        "eod_cumulative": marts.eod_cumulative(daily),
        "fact_post_metrics_daily": gold.fact_post_metrics_daily(posts, daily),
        "trending_hashtags": marts.trending_tags(tag_days, top_tags),
        "share_of_voice": marts.share_of_voice(mentions),
        "monthly_rollup": marts.monthly_rollup(facts, calendar, "engagement_value"),
        "top_posts": marts.top_posts(posts, top_posts).select(
            "post_sk", *gold.POST_KEY, "total_engagement", "engagement_tier", "rank"),
    }
    for name, df in tables.items():
        publish(df, f"{target}/{name}")
