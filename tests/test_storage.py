from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from feedforge.operators.quality import QualityGateError
from feedforge.plans import jobs
from feedforge.plans.jobs import build_gold, build_marts, run_silver
from feedforge.sources.readers import (
    backfill_range, check_range, days_between, missing_days, path_exists, read_landing_array,
    read_raw, read_raw_days, read_table,
)
from feedforge.sources.snapshots import publish
from feedforge.sources.schemas import NARROW, REQUIRED, raw_schema
from feedforge.sources.workdir import work_dir, work_root
from feedforge.sources.writers import dry_run, replace_table, write_partitions, write_raw

UUIDS = [f"00000000-0000-4000-8000-{i:012d}" for i in range(50)]


def tweet(i, at, **changes):
    row = {"tweet_id": UUIDS[i], "user_id": f"u{i % 3}", "platform": " Twitter", "content": f" text {i} ",
           "hashtags": ["Spark", "data"] if i % 2 else [], "mentions": None, "language": "EN",
           "likes_count": -1 if i == 0 else i * 10, "retweets_count": i, "replies_count": None,
           "user_account_type": "brand", "created_at": at, "ingested_at": at, "not_declared": 1}
    return {**row, **changes}


def engagement(i, post, at, **changes):
    row = {"engagement_id": f"e{i}", "post_id": post, "engaging_user_id": f"u{i % 4}", "platform": "twitter",
           "engagement_type": ["like", "View", "clap"][i % 3], "created_at": at, "ingested_at": at}
    return {**row, **changes}


def put(folder, rows, name="part.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    for d in (15, 16):
        day = f"year=2024/month=01/day={d}"
        at = f"2024-01-{d}T10:00:00+00:00"
        tweets = [tweet(i, at) for i in range(5)] + [tweet(1, f"2024-01-{d}T12:00:00Z", content="newer")]
        tweets.append(tweet(9, at, user_id=None))
        put(root / "twitter/tweets" / day / "hour=10", tweets)
        put(root / "twitter/engagements" / day / "hour=10",
            [engagement(i, UUIDS[i % 5], at) for i in range(12)] + [engagement(99, None, at)])
        put(root / "youtube/videos" / day / "hour=11",
            [{"video_id": "v1", "channel_id": "c1", "title": "a video", "view_count": 10, "like_count": 4,
              "published_at": at, "ingested_at": at, "tags": ["Data"]}])
        put(root / "reddit/posts" / day / "hour=11",
            [{"post_id": "r1", "author_user_id": "a1", "title": "a post", "score": 7, "num_comments": 2,
              "posted_at": at, "ingested_at": at}])
    return root


def test_schemas():
    sizes = {e: len(raw_schema(e)) for e in REQUIRED}
    assert sizes == {"twitter.tweets": 22, "twitter.engagements": 12, "youtube.videos": 26, "youtube.comments": 15,
                     "youtube.snapshots": 9, "reddit.posts": 29, "reddit.comments": 21}
    assert all(set(REQUIRED[e]) <= set(raw_schema(e).fieldNames()) for e in REQUIRED)
    assert [len(raw_schema(e, NARROW[e])) for e in NARROW] == [10, 9]


def test_enforced_read(spark, tmp_path):
    put(tmp_path / "j", [tweet(1, "x"), {"tweet_id": 5, "likes_count": "many"}])
    with open(tmp_path / "j/part.json", "a") as f:
        f.write("\n{broken")
    df = read_raw(spark, str(tmp_path / "j"), "twitter.tweets")
    assert "not_declared" not in df.columns
    assert df.count() == 3 and df.filter("tweet_id is null").count() == 1


def test_landing_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"video_id": "1"}, {"video_id": "2"}]))
    assert read_landing_array(spark, str(tmp_path), "youtube.videos").count() == 2


def test_day_scan_reads_only_its_days(spark, bronze, plan):
    df = read_raw_days(spark, f"{bronze}/twitter/tweets", "twitter.tweets", date(2024, 1, 15), date(2024, 1, 15))
    assert df.count() == 7 and "hour" not in df.columns
    text = plan(df)
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    assert {p.rsplit("day=", 1)[1][:2] for p in df.inputFiles()} <= {"15", "16"}
    scanned = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(scanned) == 1 and "day=15" in scanned[0]["f"]


@pytest.mark.parametrize("start, end", [
    (date(2024, 1, 30), date(2024, 3, 2)), (date(2023, 12, 31), date(2024, 1, 1)), (date(2024, 2, 29), date(2024, 2, 29)),
])
def test_days_between(spark, start, end):
    days = spark.range(800).select(F.date_add(F.lit(date(2023, 1, 1)), F.col("id").cast("int")).alias("d"))
    parts = days.select("d", F.year("d").alias("year"), F.month("d").alias("month"), F.day("d").alias("day"))
    got = parts.filter(days_between(start, end)).agg(F.count("d"), F.min("d"), F.max("d")).first()
    assert tuple(got) == ((end - start).days + 1, start, end)


def test_check_range():
    assert check_range("2024-01-01", "2024-03-30") == (date(2024, 1, 1), date(2024, 3, 30))
    for bad in (("2024-01-02", "2024-01-01"), ("2024-01-01", "2024-03-31"), ("", "2024-01-01"), ("x", "y")):
        with pytest.raises(ValueError):
            check_range(*bad)


def test_backfill_is_pushed_to_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(10).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int))").alias("ts")) \
        .write.parquet(path)
    df = backfill_range(spark.read.parquet(path), "ts", "2024-01-03", "2024-01-04")
    assert df.count() == 2 and "GreaterThanOrEqual(ts" in plan(df)


def test_missing_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 2),)], "d date")
    got = [r[0].day for r in missing_days(df, "d", date(2024, 1, 1), date(2024, 1, 4)).collect()]
    assert sorted(got) == [1, 3, 4]


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, datetime(2024, 1, 1) + timedelta(days=i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, ingested_at timestamp")
    assert write_partitions(df, path, rebalance=True) == 30
    again = df.filter("id % 3 = 1").withColumn("id", F.col("id") + 100)
    assert write_partitions(again, path) == 10
    back = spark.read.parquet(path)
    assert back.count() == 30 and back.filter("id >= 100").count() == 10
    assert write_partitions(again, path, mode="append") == 10
    assert spark.read.parquet(path).count() == 40
    replace_table(again, path)
    assert spark.read.parquet(path).count() == 10


def test_raw_files_are_bounded(spark, tmp_path):
    df = spark.range(105).coalesce(1).select("id", F.lit("2024-01-15T07:00:00Z").alias("ingested_at"))
    assert write_raw(df, str(tmp_path / "r"), max_records=25) == 105
    files = list((tmp_path / "r/year=2024/month=01/day=15/hour=07").glob("*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 25, 25, 25, 25]


def test_dry_run_counts(spark):
    assert dry_run(spark.range(42)) == 42


def test_work_dir_follows_the_session(spark, tmp_path):
    assert work_dir(spark, "x").startswith(work_root(spark)) and work_dir(spark, "x") != work_dir(spark, "x")
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs:///shared/"}, sparkContext=spark.sparkContext)
    assert work_root(named) == "hdfs:///shared"
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        work_root(cluster)
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "absent"))


def test_silver_then_gold(spark, bronze, tmp_path):
    silver, quarantine, gold = (str(tmp_path / n) for n in ("silver", "quarantine", "gold"))
    summary = run_silver(spark, str(bronze), silver, "2024-01-15", "2024-01-16", quarantine=quarantine).first()
    assert (summary["records_read"], summary["records_rejected"]) == (44, 4)
    tweets = read_table(spark, f"{silver}/tweets")
    assert tweets.count() == 10 and summary["records_written"] == 10 + 24 + 14
    row = tweets.filter(f"tweet_id = '{UUIDS[1]}' and day = 15").first()
    assert row["content"] == "newer" and row["platform"] == "twitter" and row["user_account_type"] == "BRAND"
    zero = tweets.filter(f"tweet_id = '{UUIDS[0]}' and day = 15").first()
    assert (zero["likes_count"], zero["replies_count"], zero["hashtag_count"], zero["mention_count"],
            zero["content"], zero["content_length"], zero["is_reply"], zero["has_media"]) == \
        (0, 0, 0, 0, "text 0", 6, False, False)
    assert spark.read.parquet(f"{quarantine}/twitter/tweets").count() == 2

    before = {tuple(r) for r in tweets.drop("silver_batch_id", "silver_processed_at", "hashtags", "mentions").collect()}
    run_silver(spark, str(bronze), silver, "2024-01-16", quality=str(tmp_path / "quality"))
    after = read_table(spark, f"{silver}/tweets").drop("silver_batch_id", "silver_processed_at", "hashtags", "mentions")
    assert {tuple(r) for r in after.collect()} == before and after.count() == 10

    build_gold(spark, silver, gold, quality=str(tmp_path / "quality"))
    rows = {n: spark.read.parquet(f"{gold}/{n}").count() for n in (
        "dim_date", "dim_posts", "dim_platforms", "dim_hashtags", "fact_engagements", "fact_post_metrics")}
    # Both days carry the same records: Gold has the later version of each.
    assert rows == {"dim_date": 4017, "dim_posts": 7, "dim_platforms": 3, "dim_hashtags": 2,
                    "fact_engagements": 12, "fact_post_metrics": 7}
    tags = {r["hashtag"] for r in spark.read.parquet(f"{gold}/dim_hashtags").collect()}
    assert tags == {"spark", "data"}

    kpi = {r["suite"]: r["decision"] for r in spark.read.parquet(str(tmp_path / "quality/kpi")).collect()}
    assert kpi == dict.fromkeys(("quick.silver.tweets", "silver.tweets", "silver.engagements", "silver.posts",
                                 "gold.fact_engagements", "gold.fact_post_metrics"), "pass")

    mart = str(tmp_path / "marts")
    build_marts(spark, silver, gold, mart)
    users = spark.read.parquet(f"{mart}/daily_active_users").first()
    assert (str(users["activity_date"]), users["active_users"], users["n_events"]) == ("2024-01-16", 4, 12)
    reach = {r["post_id"]: r["reach"] for r in spark.read.parquet(f"{mart}/post_reach").collect()}
    assert reach == {UUIDS[i]: 3 if i < 2 else 2 for i in range(5)}
    trend = {r["tag"]: r["rolling_engagement"] for r in spark.read.parquet(f"{mart}/trending_hashtags").collect()}
    assert trend == {"spark": 5, "data": 5}
    history = spark.read.parquet(f"{gold}/dim_users")
    assert history.filter("is_brand and account_type = 'BRAND' and platform = 'twitter'").count() == 3
    facts = spark.read.parquet(f"{gold}/fact_engagements")
    assert facts.filter("post_sk is null or platform_sk is null").count() == 0
    known = facts.join(history, "user_sk")
    assert known.count() == 9 and known.filter("engaging_user_id <> user_id").count() == 0
    assert history.filter("is_current").count() == history.count() == 3
    assert spark.read.parquet(f"{mart}/monthly_rollup").filter("level = 3").first()["n_rows"] == 12
    for name in ("eod_cumulative", "fact_post_metrics_daily", "top_posts"):
        assert spark.read.parquet(f"{mart}/{name}").count() > 0


def test_a_range_of_days_shuffles_each_record_once(spark, tmp_path, monkeypatch, plan):
    bronze, silver = tmp_path / "b" / "year=2023/month=01/day=01", str(tmp_path / "s")
    for day in (15, 16, 17):
        at = f"2024-01-{day}T10:00:00Z"
        user = {"user_id": None} if day == 16 else {}  # a day without a valid tweet, amid others
        hour = f"year=2024/month=01/day={day}/hour=10"
        put(bronze / "twitter/tweets" / hour, [tweet(i % 4, at, **user) for i in range(8)])
        put(bronze / "twitter/engagements" / hour, [engagement(i % 6, UUIDS[0], at) for i in range(9)])
        if day != 17:  # videos came on fewer days, forum posts never
            put(bronze / "youtube/videos" / hour, [{"video_id": f"v{i % 2}", "channel_id": "c", "title": "t",
                                                    "published_at": at, "ingested_at": at} for i in range(3)])
    laid_out = {}

    def noted(df, root, *args, rebalance=False, **kwargs):
        text = plan(df)
        laid_out[os.path.basename(root)] = rebalance, text.count("Exchange"), text.count("WindowGroupLimit"), "REBALANCE" in text
        return publish(df, root, *args, rebalance=rebalance, **kwargs)

    monkeypatch.setattr(jobs, "publish", noted)
    run_silver(spark, str(bronze), silver, "2024-01-14", "2024-01-18", check=False)
    # A shuffle per day with rows, copies cut before and after it, none to gather the days.
    assert [laid_out[n] for n in ("tweets", "engagements", "posts")] == [(False, 3, 6, False), (False, 3, 6, False), (False, 2, 4, False)]
    for name, n_days in (("tweets", 2), ("engagements", 3)):  # a file is named after the task that wrote it
        written = list(Path(silver, name).rglob("part-*.parquet"))
        assert len({f.parent for f in written}) == n_days and len({f.name[:10] for f in written}) == len(written)
    ledger = {r["entity"]: r for r in read_table(spark, f"{silver}/ledger").collect()}
    assert {n: (r["records_read"], r["records_rejected"], r["records_kept"]) for n, r in ledger.items()} == {
        "tweets": (24, 8, 8), "engagements": (27, 0, 18), "posts": (8 + 6, 0, 8 + 4)}
    days = read_table(spark, f"{silver}/posts").groupBy("platform", "day").count().collect()
    assert {(r["platform"], r["day"]): r["count"] for r in days} == {
        ("twitter", 15): 4, ("twitter", 17): 4, ("youtube", 15): 2, ("youtube", 16): 2}


def test_silver_without_data_is_skipped(spark, bronze, tmp_path):
    empty = run_silver(spark, str(bronze), str(tmp_path / "s"), "2023-05-01").first()
    assert empty["records_read"] == 0 and not (tmp_path / "s").exists()
    only_tweets = tmp_path / "only"
    put(only_tweets / "twitter/tweets/year=2024/month=01/day=15/hour=10", [tweet(1, "2024-01-15T10:00:00Z")])
    done = run_silver(spark, str(only_tweets), str(tmp_path / "s"), "2024-01-15").first()
    assert (done["records_read"], done["records_written"]) == (1, 2)


def test_silver_gate_blocks(spark, tmp_path):
    day = "year=2024/month=01/day=15/hour=10"
    for entity in ("twitter/engagements", "youtube/videos", "reddit/posts"):
        put(tmp_path / "b" / entity / day, [{}])
    put(tmp_path / "b/twitter/tweets" / day, [tweet(1, "not a time")])
    with pytest.raises(QualityGateError):
        run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), "2024-01-15")


def test_silver_gate_covers_engagements_and_keeps_its_outcome(spark, bronze, tmp_path):
    at = "2024-01-15T13:00:00Z"
    put(bronze / "twitter/engagements/year=2024/month=01/day=15/hour=13",
        [engagement(200 + i, UUIDS[0], at, platform="elsewhere") for i in range(3)])
    with pytest.raises(QualityGateError, match="silver.engagements"):
        run_silver(spark, str(bronze), str(tmp_path / "s"), "2024-01-15", quality=str(tmp_path / "q"))
    kept = spark.read.parquet(str(tmp_path / "q/results")).filter("not success").collect()
    assert [r["suite"] for r in kept] == ["silver.engagements"] and "elsewhere" in kept[0]["details"]
    kpi = {r["suite"]: r["decision"] for r in spark.read.parquet(str(tmp_path / "q/kpi")).collect()}
    assert kpi["silver.engagements"] == "block" and kpi["silver.tweets"] == "pass"


def test_loads_are_compressed_and_read_like_plain_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"id-{n}", None) for n in range(200)], "name_of_the_field string, ingested_at string")
    root = str(tmp_path / "loads")
    assert write_raw(rows, root, load="s-00000000") == 200
    files = [f for f in (tmp_path / "loads").rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    # A plain file of before, in the same table.
    files[0].with_name("part-old.json").write_text('{"name_of_the_field": "old"}\n')
    back = spark.read.schema("name_of_the_field string").json(root)
    assert back.count() == 201 and back.where("name_of_the_field = 'old'").count() == 1
