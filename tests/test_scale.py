"""Plans and results with one key holding a third of all rows."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from feedforge.operators.dedup import dedup_latest
from feedforge.plans import gold, marts

T0 = "timestamp'2024-01-01'"
PLATFORM = "if(cast(substring(post_id, 2) as int) % 2 = 0, 'twitter', 'youtube') as platform"


@pytest.fixture
def posts(spark):
    df = spark.range(2000).selectExpr(
        "concat('p', id) as post_id", "concat('u', id % 9) as user_id", PLATFORM,
        "'text' as content", "array('a') as hashtags", f"{T0} + make_dt_interval(cast(id % 5 as int)) as posted_at",
        "id as likes_count", "id as shares_count", "id as comments_count", "id as impressions_count",
        f"{T0} as ingested_at", "'b' as silver_batch_id")
    return gold.posts_enriched(gold.stg_posts(df))


@pytest.fixture
def engaged(spark):
    return spark.range(0, 60000, 1, 16).selectExpr(
        "concat('e', id) as engagement_id", "case when id % 3 = 0 then 'p7' else concat('p', id % 2500) end as post_id",
        "concat('u', id % 700) as engaging_user_id", "'x' as post_author_id", PLATFORM,
        "'LIKE' as engagement_type", "'c' as engagement_content", "1.0D as engagement_value",
        f"{T0} + make_dt_interval(cast(id % 20 as int)) as engaged_at", f"{T0} as ingested_at", "'b' as silver_batch_id")


def final_plan(df) -> str:
    """The plan adaptive execution ended with."""
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_targets(spark):
    """Thresholds low enough for test data to count as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_the_fact_join_splits_a_hot_post(spark, posts, engaged, small_targets):
    fact = gold.fact_engagements(engaged, posts)
    assert "skew=true" in final_plan(fact)
    assert fact.count() == 60000
    known = fact.agg(F.count("post_date")).first()[0]
    assert known == engaged.filter("cast(substring(post_id, 2) as int) < 2000").count()


def test_a_hot_post_is_summed_before_the_shuffle(posts, engaged, plan):
    daily = gold.daily_engagements(engaged)
    text = plan(daily)
    assert text.index("HashAggregate") < text.index("Exchange") and "partial_count" in text
    metrics = gold.fact_post_metrics(posts, daily)
    assert metrics.count() == 2000
    hot = gold.fact_post_metrics_daily(posts, daily).filter("post_id = 'p7'")
    total = hot.agg(F.sum("total_engagement_events")).first()[0]
    assert total == engaged.filter("post_id = 'p7'").count()


def test_daily_counts_need_no_join(engaged, plan):
    assert "Join" not in plan(gold.daily_engagements(engaged))


def test_reach_spreads_a_hot_post_over_its_accounts(engaged, plan):
    reach = marts.post_reach(engaged, ["post_id"], "engaging_user_id")
    text = plan(reach)
    assert "hashpartitioning(post_id" in text and text.count("Exchange") == 2
    first = text[text.rindex("Exchange"):]
    assert "engaging_user_id" in first.split("\n")[0]
    assert reach.filter("post_id = 'p7'").first()["reach"] == 700


def test_share_of_voice_has_no_window(engaged, plan):
    sov = marts.share_of_voice(engaged.withColumn("brand", F.col("post_id")))
    assert "Window" not in plan(sov)
    sums = sov.groupBy("platform").agg(F.sum("share_pct")).collect()
    assert len(sums) == 2 and all(abs(s - 100) < 0.5 for _, s in sums)


def test_top_posts_are_cut_before_the_shuffle(posts, plan):
    text = plan(marts.top_posts(posts, 10).select("post_id", "rank"))
    assert "WindowGroupLimit" in text[text.index("Exchange"):] and "content" not in text[text.index("Exchange"):]


def test_no_plan_multiplies_rows(spark, posts, engaged, plan):
    users = marts.dim_users(engaged, ["engagement_type"], "engaging_user_id", "engaged_at", ("engagement_id",)) \
        .withColumnRenamed("engaging_user_id", "user_id")
    daily = gold.daily_engagements(engaged)
    for df in (gold.fact_engagements(engaged, posts), gold.fact_post_metrics(posts, daily),
               gold.fact_with_keys(gold.fact_engagements(engaged, posts), users, gold.dim_platforms(posts))):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_texts_are_cut_before_the_dedup_of_gold(spark):
    df = spark.range(20).selectExpr(
        "concat('p', id % 10) as post_id", "'u' as user_id", "'twitter' as platform",
        "if(id = 3, null, repeat('long text ', cast(id * 40 as int))) as content", "array('a') as hashtags",
        f"{T0} as posted_at", "id as likes_count", "id as shares_count", "id as comments_count",
        "id as impressions_count", f"{T0} + make_dt_interval(cast(id as int)) as ingested_at", "'b' as silver_batch_id")

    def dim(posts):
        return gold.dim_posts(gold.posts_enriched(gold.stg_posts(posts)), F.lit(None)).orderBy("post_sk").collect()

    assert dim(dedup_latest(gold.previewed(df), gold.POST_KEY)) == dim(dedup_latest(df, gold.POST_KEY))
