from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.compare import compare
from checks.registry import Tables
from checks.streams import table_stream
from feedforge.operators.retention import file_manifest, processed_files, retention_candidates
from feedforge.sources.readers import read_raw_days
from feedforge.sources.schemas import LANDING, TOPICS
from feedforge.sources.workdir import work_dir
from feedforge.streaming import ingest
from feedforge.streaming.ingest import (
    Counters, decode, file_messages, ingest_landing, ingest_new_files, kafka_messages, run_for, stream_ingest,
    topic_batch_writer, landing_stream,
)
from feedforge.streaming.stateful import (
    drain_append, drain_update, stream_daily_counts, stream_dedup, stream_interval_join,
)

VIDEOS = LANDING[0]
T0 = datetime(2024, 1, 1)


def video(i, **changes):
    return {"video_id": f"v{i}", "channel_id": "c", "platform": "youtube", "published_at": "2024-01-01T00:00:00Z",
            "ingested_at": "2024-01-02T03:00:00Z", **changes}


def land(root, name, rows, prefix=VIDEOS.prefix):
    folder = root / prefix
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows))


def message(topic, row):
    return {"topic": topic.name, "value": row if isinstance(row, str) else json.dumps(row)}


def tweet(i, **changes):
    return {"tweet_id": f"t{i}", "user_id": "u", "platform": "twitter", "created_at": "2024-01-01T00:00:00Z",
            "ingested_at": "2024-01-02T03:00:00Z", **changes}


def test_landing_files_are_ingested_once(spark, tmp_path):
    landing, bronze, seen = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "seen")
    land(landing, "a.json", [video(1), video(2), video(3, channel_id=None)])
    args = (spark, VIDEOS, str(landing), bronze, seen)
    assert ingest_new_files(*args, "r1") == Counters(3, 2, 1, 1)
    assert ingest_new_files(*args, "r2") == Counters()
    land(landing, "b.json", [video(4)])
    assert ingest_new_files(*args, "r3", dry_run=True) == Counters(4, 3, 1, 2)
    assert ingest_new_files(*args, "r4") == Counters(1, 1, 0, 1)
    rows = spark.read.json(f"{bronze}/{VIDEOS.path}")
    assert {r["video_id"] for r in rows.collect()} == {"v1", "v2", "v4"}
    assert {r["batch_id"] for r in rows.collect()} == {"r1", "r4"}
    assert rows.filter("not source_file like '%.json'").count() == 0
    # Laid out by the day of ingestion, not by the record's own time.
    today = datetime.now(timezone.utc).date()
    assert read_raw_days(spark, f"{bronze}/{VIDEOS.path}", "youtube.videos", today - timedelta(days=1), today).count() == 3
    manifest = file_manifest(spark, str(landing))
    expired = retention_candidates(manifest, processed_files(rows), date.today() + timedelta(days=9))
    assert expired.count() == 2
    assert ingest_new_files(*args, "r5", reprocess=True) == Counters(4, 3, 1, 2)
    assert spark.read.json(f"{bronze}/{VIDEOS.path}").count() == 6
    letters = spark.read.json(f"{bronze}/_dead_letters/{VIDEOS.path}")
    assert letters.filter("error like '%channel_id%' and original_message like '%v3%'").count() == 2


def test_all_landing_folders(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    land(landing, "a.json", [video(1)])
    land(landing, "m.json", [{"name": "r/x", "members": 5}], LANDING[5].prefix)
    summary = ingest_landing(spark, str(landing), bronze, str(tmp_path / "state")).first()
    assert (summary["records_read"], summary["records_written"], summary["files_processed"]) == (2, 2, 2)
    only = ingest_landing(spark, str(landing), bronze, str(tmp_path / "state"), sources=["nothing"]).first()
    assert only["records_read"] == 0
    assert spark.read.json(f"{bronze}/_runs").count() == 2
    assert spark.read.json(f"{bronze}/reddit/subreddits").first()["members"] == 5


def test_topics_are_routed_and_rejects_kept(spark, tmp_path):
    rows = [message(TOPICS[0], tweet(1)), message(TOPICS[0], tweet(2, user_id=None)), message(TOPICS[0], "{broken"),
            message(TOPICS[1], {"engagement_id": "e", "post_id": "p", "engaging_user_id": "u", "engagement_type": "like",
                                "ingested_at": "2024-01-02T03:00:00Z"})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.json").write_text("\n".join(json.dumps(r) for r in rows))
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "cp")
    query, counters = stream_ingest(file_messages(spark, str(tmp_path / "in")), bronze, checkpoint, "run", drain=True)
    assert run_for(query, 120)
    assert (counters.records_read, counters.records_written, counters.records_rejected) == (4, 2, 2)
    assert spark.read.json(f"{bronze}/twitter/tweets").first()["tweet_id"] == "t1"
    letters = spark.read.json(f"{bronze}/_dead_letters/twitter/tweets").collect()
    assert {r["original_message"] for r in letters} == {json.dumps(tweet(2, user_id=None)), "{broken"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    batch = spark.createDataFrame([(TOPICS[0].name, json.dumps(tweet(i))) for i in range(4)], "topic string, value string")
    write = topic_batch_writer(str(tmp_path), "run", "cp", Counters())
    for epoch in (0, 1, 1):
        write(batch, epoch)
    assert spark.read.json(f"{tmp_path}/twitter/tweets").count() == 8


def test_a_batch_is_stored_without_a_cache_and_each_pass_parses_once(spark, tmp_path, monkeypatch, plan):
    plans = []

    def watched(df, path, **named):
        plans.append(plan(df))
        return store(df, path, **named)

    store = ingest.write_raw
    monkeypatch.setattr(ingest, "write_raw", watched)
    rows = [(TOPICS[0].name, json.dumps(tweet(1))), (TOPICS[0].name, "{broken"), (TOPICS[1].name, "{}"), (None, "x")]
    counters = Counters()
    topic_batch_writer(str(tmp_path), "run", "cp", counters)(spark.createDataFrame(rows, "topic string, value string"), 0)
    assert counters == Counters(4, 1, 3, 0)
    assert len(plans) == 5 and not any("InMemory" in p for p in plans)
    # Valid records are read as their schema and as a map of undeclared fields, rejects as their schema.
    assert [p.count("from_json") for p in plans] == [2, 1, 2, 1, 0]


def test_an_ingest_caches_nothing(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.json").write_text("\n".join(json.dumps(message(t, tweet(1))) for t in TOPICS))
    cached = []
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *_: cached.append(df) or df)
    query, counters = stream_ingest(file_messages(spark, str(tmp_path / "in")), str(tmp_path / "b"), str(tmp_path / "cp"),
                                    "run", drain=True)
    assert run_for(query, 120)
    assert (counters.records_read, counters.records_written, counters.records_rejected) == (2, 1, 1) and not cached


def test_a_stream_can_be_stopped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query, _ = stream_ingest(file_messages(spark, str(tmp_path / "in")), str(tmp_path / "b"), str(tmp_path / "cp"),
                             "run", seconds=1)
    assert not run_for(query, 2) and not query.isActive


def test_dry_run_writes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m.json").write_text(json.dumps(message(TOPICS[0], tweet(1))))
    query, counters = stream_ingest(file_messages(spark, str(tmp_path / "in")), str(tmp_path / "b"),
                                    str(tmp_path / "cp"), "run", drain=True, dry_run=True)
    query.awaitTermination()
    assert counters.records_written == 1 and not (tmp_path / "b").exists()


def test_the_broker_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_messages(spark, "broker:9092")


def test_decode_keeps_the_text(spark):
    df = spark.createDataFrame([(TOPICS[0].name, '{"tweet_id": "a"}'), ("other", "{}")], "topic string, value string")
    rows = decode(df, TOPICS[0]).collect()
    assert len(rows) == 1 and rows[0]["tweet_id"] == "a" and rows[0]["_message"] == '{"tweet_id": "a"}'


def test_undeclared_fields_are_kept(spark):
    texts = ['{"tweet_id": "a", "colour": "blue", "more": {"x":1}}', '{"tweet_id": "b"}', "{broken"]
    df = spark.createDataFrame([(TOPICS[0].name, t) for t in texts], "topic string, value string")
    rows = {r["_message"]: r["undeclared"] for r in decode(df, TOPICS[0]).collect()}
    assert [rows[t] for t in texts] == [{"colour": "blue", "more": '{"x":1}'}, None, None]


def streamed(spark, df, files=3):
    """A table as a stream of several files, one per batch, in order."""
    path = work_dir(spark, "stream-source")
    for i in range(files):
        df.filter(F.col("n") % files == i).drop("n").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop("n").schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("spread", [None, "ts"])
def test_stream_dedup_with_a_third_of_the_rows_in_one_key(spark, spread):
    rows = [(i, 0 if i % 3 == 0 else i, T0 + timedelta(seconds=i % 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "n int, id int, ts timestamp")
    got = drain_append(stream_dedup(streamed(spark, df), ["id"], "ts", "1 day", spread), "dd")
    assert sorted(r["id"] for r in got.collect()) == sorted({r[1] for r in rows})


def test_stream_counts_equal_batch_counts(spark):
    rows = [(i, "ab"[i % 2], T0 + timedelta(hours=(i * 37) % 240)) for i in range(500)]
    df = spark.createDataFrame(rows, "n int, kind string, ts timestamp_ntz")
    got = drain_update(stream_daily_counts(streamed(spark, df), ["kind"], "ts", "30 days"), "dc", ["day", "kind"])
    batch = df.groupBy(F.to_date("ts").alias("day"), "kind").agg(F.count("*").alias("n_events"))
    assert {tuple(r) for r in got.select("day", "kind", "n_events").collect()} == {tuple(r) for r in batch.collect()}


@pytest.mark.parametrize("spread", [None, "eid"])
def test_stream_join_equals_batch_join_with_a_hot_key(spark, spread):
    posts = [(i, f"p{i}", T0 + timedelta(hours=i)) for i in range(10)]
    events = [(i, i, "p0" if i % 3 == 0 else f"p{i % 12}", T0 + timedelta(minutes=i * 7)) for i in range(300)]
    p = spark.createDataFrame(posts, "n int, post string, posted timestamp")
    e = spark.createDataFrame(events, "n int, eid int, post string, at timestamp")
    pairs = stream_interval_join(streamed(spark, p, 1), streamed(spark, e), ["post"], "posted", "at",
                                 delay="30 days", spread=spread)
    got = drain_append(pairs, "ij").select("post", "eid").collect()
    want = [(post, eid) for _, post, posted in posts for _, eid, to, at in events
            if to == post and posted < at <= posted + timedelta(hours=24)]
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_unknown_topics_become_dead_letters_and_repeats_replace(spark, tmp_path):
    from feedforge.streaming.ingest import Counters, topic_batch_writer

    batch = spark.createDataFrame([("nobody", "{}"), (None, "x")], "topic string, value string")
    counters = Counters()
    write = topic_batch_writer(str(tmp_path), "run", "checkpoint", counters)
    write(batch, 0)
    assert (counters.records_read, counters.records_written, counters.records_rejected) == (2, 0, 2)
    write(batch, 0)
    letters = spark.read.json(f"{tmp_path}/_dead_letters/_unknown")
    assert sorted(r["original_message"] for r in letters.collect()) == ["x", "{}"]


def test_a_load_is_replaced_whatever_its_hour(spark, tmp_path):
    from feedforge.sources.writers import write_raw

    rows = spark.createDataFrame([(1, "2024-01-01T10:59:59Z")], "id int, ingested_at string")
    again = spark.createDataFrame([(1, "2024-01-01T11:00:05Z")], "id int, ingested_at string")
    for df in (rows, again):
        write_raw(df, str(tmp_path / "b"), load="s-0")
    write_raw(rows, str(tmp_path / "b"), load="s-1")
    assert spark.read.json(str(tmp_path / "b")).count() == 2


def test_unanswered_posts_come_once_and_leave_no_state(spark, tmp_path):
    hours = lambda n: T0 + timedelta(hours=n)
    posts = [(f"p{i}", hours(i)) for i in range(40)] + [("end", hours(200)), ("late end", hours(400))]
    follows = [(f"p{i}", i, hours(i + 1)) for i in range(0, 40, 2)] + [("p1", 90, hours(26)), ("end", 91, hours(200)), ("none", 92, hours(400))]
    parts = {"posts": ("post_id string, posted_at timestamp", posts), "follows": ("post_id string, id int, ts timestamp", follows)}
    for name, (schema, rows) in parts.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(parts[n][0]).parquet(str(tmp_path / n)) for n in ("posts", "follows")]
    joined = stream_interval_join(*streams, ["post_id"], "posted_at", "ts", unanswered=True)
    query = (joined.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "seen")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted((r["post_id"], r["id"]) for r in spark.read.parquet(str(tmp_path / "out")).fillna(-1).collect())
    # p1 was followed after 25 hours, "end" at the same instant: both are unanswered.
    assert got == sorted([(f"p{i}", i) for i in range(0, 40, 2)] + [(f"p{i}", -1) for i in range(1, 40, 2)] + [("end", -1)])
    kept = sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])
    assert kept <= 2
    with pytest.raises(ValueError):
        stream_interval_join(*streams, ["post_id"], "posted_at", "ts", spread="id", unanswered=True)


@pytest.mark.parametrize("parts", [1, 3])
def test_a_given_table_may_be_a_folder_of_files(spark, tmp_path, parts):
    folder = str(tmp_path / f"tables-{parts}")
    spark.range(30).repartition(parts).write.parquet(f"{folder}/documents.parquet")
    spark.range(5).write.parquet(f"{folder}/other_documents.parquet")
    stream = table_stream(Tables(spark, folder), "documents")
    assert sorted(r["id"] for r in drain_append(stream, "folder").collect()) == list(range(30))


@pytest.mark.parametrize("name", ["stream_interval_join", "stream_unanswered_posts"])
def test_joins_of_tables_in_folders_equal_their_sql(spark, tmp_path, name):
    given = "/root/testdata/sf0.001"
    for table in ("documents", "events"):
        spark.read.parquet(f"{given}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    for table in ("documents", "events"):
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    assert compare(spark, con, name, str(tmp_path)) == ""


def test_a_landing_file_is_parsed_once_and_not_for_every_element(spark, tmp_path):
    (tmp_path / LANDING[0].prefix).mkdir(parents=True)
    elements = landing_stream(spark, str(tmp_path), LANDING[0])
    beside, _, below = elements._jdf.queryExecution().analyzed().toString().partition("Generate ")
    assert "parse_json" in below and "parse_json" not in beside
