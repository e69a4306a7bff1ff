"""Tables that change in one step, Bronze by ingestion day, whole landing records."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from feedforge.operators.quality import QualityGateError, enforce_completeness
from feedforge.operators.runs import layer_ledger
from feedforge.plans import silver
from feedforge.plans.jobs import run_silver
from feedforge.sources import snapshots as S
from feedforge.sources.readers import read_raw_days, read_table
from feedforge.sources.schemas import LANDING, raw_schema
from feedforge.sources.writers import write_raw
from feedforge.streaming.ingest import Counters, ingest_new_files

from test_storage import bronze, put, tweet  # noqa: F401
from test_streams import land, video


def table(spark, rows):
    return spark.createDataFrame(rows, "id int, year int, month int, day int")


def day(d, *ids):
    return [(i, 2024, 1, d) for i in ids]


def ids(df):
    return sorted(r["id"] for r in df.collect())


DAYS = ("year", "month", "day")


def test_versions_stay_readable_and_covered_days_are_replaced(spark, tmp_path):
    root = str(tmp_path / "t")
    assert S.snapshot(spark, root) is None and not S.is_snapshot_table(spark, root)
    assert S.publish(table(spark, day(15, 1, 2) + day(16, 3) + day(17, 4)), root, DAYS) == 4
    covers = S.in_days(date(2024, 1, 15), date(2024, 1, 16))
    assert S.publish(table(spark, day(16, 5)), root, DAYS, covers) == 1  # the 15th has become empty
    assert ids(S.read_snapshot(spark, root)) == [4, 5]
    assert ids(S.read_snapshot(spark, root, version=0)) == [1, 2, 3, 4]
    S.publish(table(spark, day(16, 6) + day(18, 7)), root, DAYS, append=True)
    assert ids(read_table(spark, root, "id")) == [4, 5, 6, 7]
    S.publish(table(spark, []), root, DAYS, covers)
    assert ids(S.read_snapshot(spark, root)) == [4, 7]
    S.publish(table(spark, []), root, DAYS)
    empty = S.read_snapshot(spark, root)
    assert ids(empty) == [] and empty.schema == table(spark, []).schema
    assert S.versions(spark, root) == [0, 1, 2, 3, 4]


def test_a_day_is_read_from_its_own_folder(spark, tmp_path):
    root = str(tmp_path / "t")
    for d in range(1, 9):
        S.publish(table(spark, day(d, d)), root, DAYS, append=True)
    one = S.read_snapshot(spark, root, where=S.in_days(date(2024, 1, 3), date(2024, 1, 3)))
    assert ids(one) == [3] and len(one.inputFiles()) == 1 and "day=3" in one.inputFiles()[0]
    assert ids(S.read_snapshot(spark, root, where=lambda v: v["day"] == "99")) == []


def test_a_run_lost_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    S.publish(table(spark, day(1, 1)), root, DAYS)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "put_once", lost)
        with pytest.raises(RuntimeError, match="lost"):
            S.publish(table(spark, day(1, 2)), root, DAYS)
    assert ids(S.read_snapshot(spark, root)) == [1] and S.versions(spark, root) == [0]
    S.publish(table(spark, day(1, 3)), root, DAYS)
    assert ids(S.read_snapshot(spark, root)) == [3]
    assert S.expire(spark, root, keep=1) == 2  # the first load and the one that was lost
    assert ids(S.read_snapshot(spark, root)) == [3] and S.versions(spark, root) == [1]


def test_of_two_writers_none_loses_its_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    S.publish(table(spark, day(1, 1)), root, DAYS)
    real, others = S.put_once, []

    def late(*args):
        if not others:  # another writer commits first
            others.append(1)
            S.publish(table(spark, day(2, 2)), root, DAYS, append=True)
        return real(*args)

    monkeypatch.setattr(S, "put_once", late)
    S.publish(table(spark, day(3, 3)), root, DAYS, append=True)
    assert ids(S.read_snapshot(spark, root)) == [1, 2, 3] and S.versions(spark, root) == [0, 1, 2]
    monkeypatch.setattr(S, "put_once", lambda *_: False)
    with pytest.raises(S.CommitConflict):
        S.publish(table(spark, day(4, 4)), root, DAYS, append=True)


def test_null_partitions_and_no_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, None), (2, 20240101)], "id int, date_sk int")
    S.publish(rows, root, ["date_sk"])
    assert sorted(map(tuple, S.read_snapshot(spark, root).collect())) == [(1, None), (2, 20240101)]
    assert ids(S.read_snapshot(spark, root, where=lambda v: v["date_sk"] is None)) == [1]
    S.publish(rows, str(tmp_path / "u"))
    assert ids(read_table(spark, str(tmp_path / "u"))) == [1, 2]


def test_bronze_is_laid_out_by_the_day_of_ingestion(spark, tmp_path):
    root = str(tmp_path / "b")
    odd = [{"video_id": f"v{i}", "ingested_at": at} for i, at in enumerate(("2019-05-01T00:00:00Z", "yesterday", None))]
    df = spark.createDataFrame([(r["video_id"], r["ingested_at"]) for r in odd], "video_id string, ingested_at string")
    at = datetime(2024, 1, 15, 23, 59, tzinfo=timezone.utc)
    assert write_raw(df, root, load="s-1", ingested=at) == 3
    # A repeated try after midnight replaces the first one.
    assert write_raw(df, root, load="s-1", ingested=datetime(2024, 1, 16, tzinfo=timezone.utc)) == 3
    assert write_raw(df.limit(1), root, load="s-2", ingested=datetime(2024, 1, 16, tzinfo=timezone.utc)) == 1
    for d, n in ((14, 0), (15, 3), (16, 1)):
        found = read_raw_days(spark, root, "youtube.videos", date(2024, 1, d), date(2024, 1, d))
        assert found.count() == n and all(f"day={d}" in f for f in found.inputFiles())


def test_landing_keeps_whole_records_of_any_shape(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "bronze")
    extra = {"nested": {"a": [1, {"b": None}]}, "rank": 1.5, "flag": True, "ünï": "ä\n\"x\""}
    land(landing, "a.json", [video(1, **extra), video(2, view_count="many"), 7, video(3, channel_id=None)])
    land(landing, "empty.json", [])
    (landing / LANDING[0].prefix / "one.json").write_text(json.dumps(video(4)))
    (landing / LANDING[0].prefix / "broken.json").write_text('[{"video_id": "v9"')
    done = ingest_new_files(spark, LANDING[0], str(landing), out, str(tmp_path / "seen"), "r1")
    assert (done.records_read, done.records_written, done.records_rejected) == (6, 3, 3)
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/youtube/videos").collect()]
    first = next(x for x in lines if x["video_id"] == "v1")
    assert {k: first[k] for k in extra} == extra and first["batch_id"] == "r1" and first["source_file"].endswith("a.json")
    assert {k: v for k, v in first.items() if k not in {*extra, "batch_id", "source_file"}} == video(1)
    letters = {r["original_message"]: r["error"] for r in spark.read.json(f"{out}/_dead_letters/youtube/videos").collect()}
    assert "no JSON object" in letters["7"] and "no JSON object" in letters['[{"video_id": "v9"']
    assert sum("channel_id" in e for e in letters.values()) >= 1
    today = datetime.now(timezone.utc).date()
    days = read_raw_days(spark, f"{out}/youtube/videos", "youtube.videos", today.replace(day=1), today)
    assert days.filter("view_count is null").count() == 3


def test_landing_without_a_schema_keeps_every_field(spark, tmp_path):
    landing, out, source = tmp_path / "landing", str(tmp_path / "bronze"), LANDING[5]
    land(landing, "a.json", [{"name": "x", "members": 5}, {"name": "y", "rules": [{"n": 1}]}], source.prefix)
    args = (spark, source, str(landing), out, str(tmp_path / "seen"))
    assert ingest_new_files(*args, "r1") == Counters(2, 2, 0, 1)
    land(landing, "b.json", [{"name": "z", "members": "many", "new": {"k": 0}}], source.prefix)
    assert ingest_new_files(*args, "r2") == Counters(1, 1, 0, 1)
    lines = {x["name"]: x for x in (json.loads(r[0]) for r in spark.read.text(f"{out}/reddit/subreddits").collect())}
    assert lines["y"]["rules"] == [{"n": 1}] and lines["z"]["members"] == "many" and lines["z"]["new"] == {"k": 0}


def test_emptied_and_repaired_days(spark, bronze, tmp_path):  # noqa: F811
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    run = lambda: run_silver(spark, str(bronze), silver, "2024-01-15", check=False, quarantine=quarantine).first()
    run_silver(spark, str(bronze), silver, "2024-01-16", check=False, quarantine=quarantine)
    run()
    hour = bronze / "twitter/tweets/year=2024/month=01/day=15/hour=10"
    tweets = lambda d: read_table(spark, f"{silver}/tweets").filter(f"day = {d}").count()
    letters = lambda d: read_table(spark, f"{quarantine}/twitter/tweets").filter(f"day = {d}").count()
    assert (tweets(15), letters(15), tweets(16), letters(16)) == (5, 1, 5, 1)
    put(hour, [tweet(3, "2024-01-15T10:00:00Z", user_id=None)])  # no valid row is left
    run()
    assert (tweets(15), letters(15), tweets(16), letters(16)) == (0, 1, 5, 1)
    put(hour, [tweet(3, "2024-01-15T10:00:00Z")])  # repaired: no reject is left
    done = run()
    assert (tweets(15), letters(15), tweets(16), letters(16)) == (1, 0, 5, 1)
    assert done["files_processed"] == 4


def test_ledger_balances_and_incomplete_runs_block(spark, bronze, tmp_path):  # noqa: F811
    silver = str(tmp_path / "silver")
    run_silver(spark, str(bronze), silver, "2024-01-15", "2024-01-16")
    rows = {r["entity"]: r for r in read_table(spark, f"{silver}/ledger").collect()}
    assert {e: (r["records_read"], r["records_rejected"], r["duplicates_removed"], r["records_kept"], r["files_processed"])
            for e, r in rows.items()} == {"tweets": (14, 2, 2, 10, 2), "engagements": (26, 2, 0, 24, 2), "posts": (14, 0, 0, 14, 4)}
    put(bronze / "twitter/tweets/year=2024/month=01/day=15/hour=11",
        [tweet(20 + i, "2024-01-15T11:00:00Z", user_id=None) for i in range(9)])
    with pytest.raises(QualityGateError, match="tweets 0.3333"):
        run_silver(spark, str(bronze), silver, "2024-01-15")
    assert read_table(spark, f"{silver}/ledger").count() == 6
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    enforce_completeness(layer_ledger(spark, "r", at, [("a", 100, 10, 45, 1), ("none", 0, 0, 0, 0)]))  # 45 repeats are no loss
    assert layer_ledger(spark, "r", at, [("a", 10, 3, 5, 1)]).select(F.expr(
        "records_read = records_rejected + duplicates_removed + records_kept")).first()[0]


def test_posts_of_single_tweets_need_no_shuffle_of_their_own(spark, plan):
    def rows(entity, **given):
        df = spark.createDataFrame([], raw_schema(entity))
        one = spark.range(1).select(*[F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        return one.union(one)  # delivered twice

    tweets = silver.clean_tweets(rows("twitter.tweets", tweet_id="t1", user_id="u", content="c"), "b")
    videos, reddit = rows("youtube.videos", video_id="v1"), rows("reddit.posts", post_id="r1")
    whole = silver.posts_unified(tweets, videos, reddit, "b")
    others = silver.posts_of_other_platforms(videos, reddit, "b")
    apart = silver.posts_from_tweets(tweets).unionByName(others)
    assert sorted(map(str, apart.collect())) == sorted(map(str, whole.collect())) and apart.count() == 3
    assert plan(silver.posts_from_tweets(tweets)).count("Exchange") == plan(tweets).count("Exchange")
