"""Committed tables, Bronze by ingestion day, and whole landing records."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.sources.readers import read_raw_days, read_table
from feedforge.sources.schemas import LANDING, REQUIRED
from feedforge.sources.snapshots import publish, read_snapshot
from feedforge.sources.workdir import work_dir
from feedforge.sources.writers import write_raw
from feedforge.streaming.ingest import ingest_new_files

from . import sqltext as Q
from .fixtures import raw, raw_sql
from .registry import Tables, query

# A rerun of the days 10 to 20: odd events are gone, and so is all of the 15th.
_RERUN = "date_sk between 20240110 and 20240120"
_KEPT = "event_id % 2 = 0 and date_sk <> 20240115"
_FACT = f"(select event_id, value, {Q.datekey('ts')} as date_sk from events)"
_SUMS = "count(*) as n_rows, round(sum(value), 4) as total_value"


@query("gold_snapshot", f"""
    select 'before' as version, date_sk, {_SUMS} from {_FACT} f group by 2
    union all select 'after', date_sk, {_SUMS} from {_FACT} f where not ({_RERUN}) or ({_KEPT}) group by 2
    union all select 'one day', date_sk, {_SUMS} from {_FACT} f where date_sk = 20240112 and ({_KEPT}) group by 2""")
def _(t):
    root = work_dir(t.spark, "gold-fact")
    fact = t.events.select("event_id", "value", F.date_format("ts", "yyyyMMdd").cast("int").alias("date_sk"))
    publish(fact, root, ["date_sk"], rebalance=True)
    publish(fact.where(f"{_RERUN} and {_KEPT}"), root, ["date_sk"],
            lambda part: 20240110 <= int(part["date_sk"]) <= 20240120, rebalance=True)
    reads = {
        "before": read_snapshot(t.spark, root, version=0), "after": read_table(t.spark, root),
        "one day": read_snapshot(t.spark, root, where=lambda part: part["date_sk"] == "20240112"),
    }
    return reduce(DataFrame.union, [
        df.groupBy(F.lit(name).alias("version"), "date_sk").agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 4).alias("total_value"))
        for name, df in reads.items()])


# What the records say of their ingestion is late, or no time at all.
_ODD_TIME = ("case when page_id % 7 = 0 then 'not a time' when page_id % 11 = 0 then '2019-05-01T00:00:00Z' "
             "else ingested_at end")
_PAGE = "cast(substring(video_id, 2) as bigint)"


@query("bronze_by_ingestion_day", f"""
    select 2024 as year, 3 as month, 1 + {_PAGE} % 3 as day, video_id, {_ODD_TIME.replace('page_id', _PAGE)} as ingested_at
    from {raw_sql('videos')} v where {_PAGE} % 3 < 2""")
def _(t):
    root = work_dir(t.spark, "bronze-days")
    page = F.substring("video_id", 2, 20).cast("bigint")
    rows = raw(t, "videos").withColumn("page_id", page).withColumn("ingested_at", F.expr(_ODD_TIME))
    for k in range(3):
        came = datetime(2024, 3, 1 + k, 23, 50, tzinfo=timezone.utc)
        for tried in (came, came + timedelta(hours=1)):  # tried again after midnight
            write_raw(rows.where(page % 3 == k).drop("page_id"), root, load=f"stream-{k:08d}", ingested=tried)
    days = read_raw_days(t.spark, root, "youtube.videos", date(2024, 3, 1), date(2024, 3, 2))
    return days.select("year", "month", "day", "video_id", "ingested_at")


# Records of every landing folder: a table, its key, and fields that no schema declares.
_LANDED = {
    "videos": ("pages", "page_id", "url"), "comments": ("documents", "doc_id", "source"),
    "snapshots": ("orders", "o_orderkey", "o_orderpriority"), "posts": ("customer", "c_custkey", "c_name"),
    "reddit_comments": ("part", "p_partkey", "p_name"), "subreddits": ("supplier", "s_suppkey", "s_name"),
}
_PER_FILE = 2_000  # longest array in one landing file


@query("landing_whole_records", " union all ".join(
    f"""select '{name}' as landed, '{key}-' || {key} as record_key, {note} as note, {key} % 7 as deep, 'r1' as batch_id
    from {table}""" for name, (table, key, note) in _LANDED.items()))
def _(t):
    landing, bronze, seen = (work_dir(t.spark, n) for n in ("landing", "bronze", "landing-seen"))
    parts = []
    for source, (name, (table, key, note)) in zip(LANDING, _LANDED.items()):
        required = REQUIRED.get(source.schema_key, ())
        named = F.concat(F.lit(f"{key}-"), F.col(key).cast("string"))
        record = F.struct(*[named.alias(c) for c in required], named.alias("record_key"), F.col(note).alias("note"),
                          F.struct(F.array(F.struct((F.col(key) % 7).alias("level"))).alias("list")).alias("nested"))
        files = getattr(t, table).select(F.to_json(record).alias("line"), F.floor(F.col(key) / _PER_FILE).alias("file"))
        arrays = files.groupBy("file").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("line"), ","), F.lit("]")).alias("value"))
        arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{landing}/{source.prefix}")
        ingest_new_files(t.spark, source, landing, bronze, f"{seen}/{source.path}", "r1")
        whole = F.parse_json("value")
        parts.append(t.spark.read.text(f"{bronze}/{source.path}").select(
            F.lit(name).alias("landed"), F.variant_get(whole, "$.record_key", "string").alias("record_key"),
            F.variant_get(whole, "$.note", "string").alias("note"),
            F.variant_get(whole, "$.nested.list[0].level", "bigint").alias("deep"),
            F.variant_get(whole, "$.batch_id", "string").alias("batch_id")))
    return reduce(DataFrame.union, parts)
