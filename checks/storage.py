"""Readers and writers: what comes back from storage must equal the batch result."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.functions.columns import utc_timestamp
from feedforge.operators.cleaning import dead_letter, reject_split, validate_required
from feedforge.operators.retention import retention_candidates
from feedforge.operators.runs import layer_counts
from feedforge.sources.readers import (
    backfill_range, missing_days, read_landing_array, read_raw, read_raw_days, read_table,
)
from feedforge.sources.schemas import CLEAN_KEYS, LANDING, NARROW
from feedforge.sources.snapshots import publish
from feedforge.sources.workdir import work_dir
from feedforge.sources.writers import dry_run, write_partitions, write_raw
from feedforge.streaming.ingest import ingest_new_files

from . import sqltext as Q
from .fixtures import raw, raw_sql
from .registry import Tables, query
from .silver import engagements

ARRAY_LENGTH = 5_000  # longest array in one landing file
_VIDEOS = LANDING[0]


def written_raw(t: Tables, name: str) -> str:
    path = work_dir(t.spark, f"raw-{name}")
    write_raw(raw(t, name), path)
    return path


def landing_files(t: Tables) -> str:
    """Raw videos as landing files of one JSON array each, of bounded length."""
    root = work_dir(t.spark, "landing")
    line = F.to_json(F.struct("*"))
    numbered = raw(t, "videos").select(
        line.alias("line"),
        F.floor(F.substring("video_id", 2, 20).cast("bigint") / ARRAY_LENGTH).alias("file"))
    arrays = numbered.groupBy("file").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("line"), ","), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/{_VIDEOS.prefix}")
    return root


@query("src_json_enforced", f"""
    select engagement_id, tweet_id, post_id, engaging_user_id, post_author_id, platform, engagement_type,
      content, created_at, ingested_at, source_system, schema_version, batch_id, null as source_file
    from {raw_sql('engagements')} r""")
def _(t):
    path = work_dir(t.spark, "json")
    raw(t, "engagements").withColumn("not_declared", F.lit(1)).write.json(path)
    return read_raw(t.spark, path, "twitter.engagements", lineage=True)


@query("src_json_array", f"""
    select video_id, channel_id, platform, title, {Q.joined('tags')} as tags, view_count, like_count,
      comment_count, published_at, ingested_at from {raw_sql('videos')} v""")
def _(t):
    files = read_landing_array(t.spark, f"{landing_files(t)}/{_VIDEOS.prefix}", "youtube.videos")
    return files.select("video_id", "channel_id", "platform", "title", "tags", "view_count", "like_count",
                        "comment_count", "published_at", "ingested_at")


@query("sink_bronze_json", f"""
    select engagement_id, post_id, engagement_type, content, ingested_at,
      year({Q.parsed('ingested_at')}) as year, month({Q.parsed('ingested_at')}) as month,
      day({Q.parsed('ingested_at')}) as day, hour({Q.parsed('ingested_at')}) as hour
    from {raw_sql('engagements')} r""")
def _(t):
    back = t.spark.read.schema(
        "engagement_id string, post_id string, engagement_type string, content string, ingested_at string, "
        "year int, month int, day int, hour int").json(written_raw(t, "engagements"))
    return back


@query("scan_partition_day", f"""
    select year({Q.parsed('ingested_at')}) as year, month({Q.parsed('ingested_at')}) as month,
      day({Q.parsed('ingested_at')}) as day, count(*) as n_rows, count(distinct engagement_id) as n_engagements
    from {raw_sql('engagements')} r where cast({Q.parsed('ingested_at')} as date) = date '2024-01-10' group by 1, 2, 3""")
def _(t):
    days = read_raw_days(t.spark, written_raw(t, "engagements"), "twitter.engagements",
                         date(2024, 1, 10), date(2024, 1, 10))
    return days.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col("engagement_id")).alias("n_engagements"))


@query("scan_narrow", f"""
    select video_id, channel_id, platform, title, {Q.joined('tags')} as tags, view_count, like_count, comment_count,
      published_at, ingested_at from {raw_sql('videos')} v""")
def _(t):
    narrow = NARROW["youtube.videos"]
    return read_raw(t.spark, written_raw(t, "videos"), "youtube.videos", only=narrow).select(*narrow)


@query("silver_as_source", f"""
    select engagement_type, count(*) as n_rows, round(sum(engagement_value), 4) as total_value
    from {Q.CLEAN_ENGAGEMENTS} e group by 1""")
def _(t):
    path = work_dir(t.spark, "silver-source")
    publish(engagements(t), path)
    narrow = read_table(t.spark, path, "engagement_type", "engagement_value")
    return narrow.groupBy("engagement_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("engagement_value"), 4).alias("total_value"))


@query("sink_append", """
    select year(o_orderdate) as year, o_orderkey, true as counted from orders""")
def _(t):
    path = work_dir(t.spark, "appended")
    written = 0
    for part in (0, 1):
        rows = t.orders.where(F.col("o_orderkey") % 2 == part).select("o_orderkey", "o_orderdate")
        written += write_partitions(rows, path, ["year"], mode="append", at="o_orderdate")
    back = t.spark.read.parquet(path)
    return back.select("year", "o_orderkey", F.lit(back.count() == written).alias("counted"))


@query("dry_run", "select 'orders' as source, count(*) as n_rows from orders union all select 'lineitem', count(*) from lineitem")
def _(t):
    counted = [(name, dry_run(getattr(t, name))) for name in ("orders", "lineitem")]
    return t.spark.createDataFrame(counted, "source string, n_rows bigint")


@query("backfill_range", """
    select event_type, count(*) as n_rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_ts,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_ts
    from events where ts >= date '2024-01-15' and ts < date '2024-02-11' group by 1""")
def _(t):
    return backfill_range(t.events, "ts", "2024-01-15", "2024-02-10").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("missing_partitions", """
    select cast(d as varchar) as missing_day
    from (select cast(unnest(range(date '1995-01-01', date '2002-01-01', interval 1 day)) as date) as d) s
    where d not in (select cast(l_shipdate as date) from lineitem)""")
def _(t):
    return missing_days(t.lineitem, "l_shipdate", date(1995, 1, 1), date(2001, 12, 31))


@query("sink_silver_partitions", f"""
    select engagement_id, engagement_type, engagement_value, {Q.stamp('created_at')} as created_at,
      year(ingested_at) as year, month(ingested_at) as month, day(ingested_at) as day
    from {Q.CLEAN_ENGAGEMENTS} e""")
def _(t):
    path = work_dir(t.spark, "silver")
    table = engagements(t)
    for _ in range(2):  # a rerun replaces the same partitions
        write_partitions(table, path, rebalance=True)
    return t.spark.read.parquet(path).select(
        "engagement_id", "engagement_type", "engagement_value", "created_at", "year", "month", "day")


_NULLS = "engagement_id is null or post_id is null or engaging_user_id is null or engagement_type is null"
_ERRORS = ", ".join(f"case when {c} is null then 'Required field missing or null: {c}' end"
                    for c in CLEAN_KEYS["twitter.engagements"])


@query("dlq_envelope", f"""
    select 'social.engagements' as original_topic, concat_ws('; ', {_ERRORS}) as error, post_author_id, created_at,
      ingested_at from {raw_sql('engagements')} r where {_NULLS}""")
def _(t):
    checked = validate_required(raw(t, "engagements"), "twitter.engagements")
    bad = checked.filter(F.size("errors") > 0)
    letters = dead_letter(bad, "social.engagements", F.array_join("errors", "; "))
    kept = F.from_json("original_message", "post_author_id string, created_at string, ingested_at string")
    return letters.select("original_topic", "error", kept.alias("m")).select("original_topic", "error", "m.*")


@query("run_summary", f"""
    select count(*) as records_read, count(*) filter (where {_NULLS}) as records_rejected,
      count(distinct engagement_id) filter (where not ({_NULLS})) as records_kept,
      count(*) filter (where not ({_NULLS})) - count(distinct engagement_id) filter (where not ({_NULLS}))
        as duplicates_removed
    from {raw_sql('engagements')} r""")
def _(t):
    return layer_counts(raw(t, "engagements"), CLEAN_KEYS["twitter.engagements"], ["engagement_id"])


_MANIFEST = {
    "path": "url",
    "length": "cast(length(html) as bigint)",
    "modificationTime": "cast(date '2024-01-01' + cast(page_id % 30 as int) as timestamp)",
}


@query("retention_candidates", f"""
    select url as path, length(html) as length, {Q.stamp(_MANIFEST['modificationTime'])} as "modificationTime"
    from pages where {_MANIFEST['modificationTime']} < timestamp '2024-01-14' and page_id in (select doc_id from labels)""")
def _(t):
    # Several pages may share a url; each is a file of its own.
    manifest = t.pages.selectExpr("page_id", *[f"{e} as {c}" for c, e in _MANIFEST.items()])
    done = t.labels.select(F.col("doc_id").alias("page_id"))
    return retention_candidates(manifest, done, date(2024, 1, 21), by=["page_id"]).select(*_MANIFEST)


def bronze_rows(t: Tables, bronze: str, path: str, columns: str) -> DataFrame:
    return t.spark.read.schema(columns).json(f"{bronze}/{path}")


@query("ingest_new_files", f"""
    select video_id, title, ingested_at, cast(1 as bigint) as run_of_rows from {raw_sql('videos')} v""")
def _(t):
    landing, bronze = landing_files(t), work_dir(t.spark, "bronze")
    seen = work_dir(t.spark, "landing-seen")
    first = ingest_new_files(t.spark, _VIDEOS, landing, bronze, seen, str(uuid.uuid4()))
    again = ingest_new_files(t.spark, _VIDEOS, landing, bronze, seen, str(uuid.uuid4()))
    assert first.records_read and not again.records_read  # the second run finds nothing new
    rows = bronze_rows(t, bronze, _VIDEOS.path, "video_id string, title string, ingested_at string, load string")
    return rows.select("video_id", "title", "ingested_at",
                       (F.size(F.split("load", "-")) - 1).cast("bigint").alias("run_of_rows"))
