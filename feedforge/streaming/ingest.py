"""Streams into Bronze: event topics and landing files.

Both use one pattern. A micro-batch is decoded, tagged and validated; valid
rows go to the entity's Bronze folder, the rest to the dead-letter folder. The
rows of a micro-batch land, below the hour of ingestion, in a folder named after
the stream and the batch number, which is replaced as a whole. A batch repeated
after a failure keeps the hour of its first try, so it replaces its own output and
nothing else.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedforge.operators.cleaning import dead_letter, tag_metadata, validate_required
from feedforge.operators.runs import run_summary
from feedforge.sources.readers import path_exists
from feedforge.sources.schemas import LANDING, REQUIRED, TOPICS, LandingSource, Topic, raw_schema
from feedforge.sources.workdir import work_dir
from feedforge.sources.writers import append_run_log, write_lines, write_raw

# Flush at least this often or at this many records.
FLUSH_SECONDS = 30
FLUSH_RECORDS = 10_000

MOST_RECORDS = 20_000_000
# Files are new if the checkpoint has not seen them, however old they are.
ANY_AGE = "36500d"
FILES_PER_BATCH = 256
NO_OBJECT = "Record is no JSON object"


@dataclass
class Counters:
    """What a stream did so far."""

    records_read: int = 0
    records_written: int = 0
    records_rejected: int = 0
    files_processed: int = 0


def kafka_messages(spark: SparkSession, servers: str, topics: Sequence[Topic] = TOPICS,
                   flush_records: int = FLUSH_RECORDS, flush_seconds: int = FLUSH_SECONDS,
                   most_records: int = MOST_RECORDS) -> DataFrame:
    """(topic, value) from the broker, from the earliest offset.

    A batch starts once enough records wait or enough time has passed, and takes
    what is there up to ``most_records``, so that a backlog is worked off in
    batches of bounded size. Needs the Kafka connector package on the session's
    class path.
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(t.name for t in topics))
            .option("startingOffsets", "earliest")
            .option("minOffsetsPerTrigger", flush_records)
            .option("maxTriggerDelay", f"{flush_seconds}s")
            .option("maxOffsetsPerTrigger", most_records)
            .load().select("topic", F.col("value").cast("string").alias("value")))


def file_messages(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(topic, value) from NDJSON files; stands in for the broker."""
    return (spark.readStream.schema("topic string, value string")
            .option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", ANY_AGE).json(path))


def decode(messages: DataFrame, topic: Topic) -> DataFrame:
    """Messages of one topic as records, the original text kept as ``_message``.

    Fields that the schema does not declare are kept as text in the map
    ``undeclared``, which is null where there are none.
    """
    schema = raw_schema(topic.schema_key)
    others = F.map_filter(F.from_json("value", "map<string,string>"), lambda name, _: ~name.isin(*schema.fieldNames()))
    return (messages.filter(F.col("topic") == topic.name)
            .select(F.from_json("value", schema).alias("_r"), others.alias("_others"), F.col("value").alias("_message"))
            .select("_r.*", F.when(F.size("_others") > 0, F.col("_others")).alias("undeclared"), "_message"))


def validated(records: DataFrame, schema_key: str | None, run_id: str,
              source_file: str | Column | None = None, now: Column | None = None) -> DataFrame:
    """Tag and validate; works on streams and tables. Adds ``errors``."""
    return validate_required(tag_metadata(records, run_id, source_file, now), schema_key)


def is_valid() -> Column:
    return F.size("errors") == 0


def load_name(checkpoint: str, epoch: int) -> str:
    """Name of a micro-batch that is the same when the batch is repeated."""
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:8]}-{epoch:08d}"


def _parsed_first(records: DataFrame) -> DataFrame:
    """The same rows; a filter on them is not moved below the parsing.

    There it would parse each required field of a message anew. An observation stops it.
    """
    return records.observe("parsed", F.count(F.lit(1)).alias("rows"))


def _store(checked: DataFrame, bronze: str, path: str, topic: str, load: str,
           counters: Counters, dry_run: bool) -> None:
    good = _parsed_first(checked).filter(is_valid()).drop("errors", "_message")
    bad = _parsed_first(checked.select("errors", "_message")).filter(~is_valid())
    letters = dead_letter(bad, topic, F.array_join("errors", "; "), message=F.col("_message"))
    if dry_run:
        counts = checked.agg(F.count_if(is_valid()).alias("good"), F.count_if(~is_valid()).alias("bad")).first()
        written, rejected = counts["good"], counts["bad"]
    else:
        written = write_raw(good, f"{bronze}/{path}", load=load)
        rejected = write_raw(letters, f"{bronze}/_dead_letters/{path}", load=load)
    counters.records_written += written
    counters.records_rejected += rejected
    counters.records_read += written + rejected


def _store_unknown(batch: DataFrame, bronze: str, load: str, counters: Counters,
                   topics: Sequence[Topic], dry_run: bool) -> None:
    """Messages of topics that nobody reads, or of none, become dead letters."""
    known = F.coalesce(F.col("topic").isin(*[t.name for t in topics]), F.lit(False))
    others = batch.filter(~known)
    letters = dead_letter(others, F.col("topic"), F.lit("unknown topic"), message=F.col("value"))
    rejected = others.count() if dry_run else \
        write_raw(letters, f"{bronze}/_dead_letters/_unknown", load=load)
    counters.records_read += rejected
    counters.records_rejected += rejected


def topic_batch_writer(bronze: str, run_id: str, checkpoint: str, counters: Counters,
                       topics: Sequence[Topic] = TOPICS,
                       dry_run: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that routes every topic to its Bronze folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        # Nothing is cached: a batch may be larger than memory, and cached text goes to
        # disk through buffers of hundreds of MB a task. Every folder is a pass over the messages.
        load = load_name(checkpoint, epoch)
        for topic in topics:
            checked = validated(decode(batch, topic), topic.schema_key, run_id)
            _store(checked, bronze, topic.path, topic.name, load, counters, dry_run)
        _store_unknown(batch, bronze, load, counters, topics, dry_run)

    return write


def stream_ingest(messages: DataFrame, bronze: str, checkpoint: str, run_id: str,
                  topics: Sequence[Topic] = TOPICS, seconds: int | None = None,
                  drain: bool = False, dry_run: bool = False) -> tuple[StreamingQuery, Counters]:
    """Start the topic ingest; ``drain`` processes what is there and stops.

    Batches follow the source (see ``kafka_messages``) unless ``seconds`` sets a
    fixed pace. Offsets are committed by the checkpoint after the whole batch is
    written.
    """
    counters = Counters()
    writer = (messages.writeStream.queryName(f"ingest-{run_id}")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(topic_batch_writer(bronze, run_id, checkpoint, counters, topics, dry_run)))
    if drain:
        writer = writer.trigger(availableNow=True)
    elif seconds is not None:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start(), counters


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a stream run for a while, then stop it after its current batch.

    True if it ended by itself. What an interrupted batch did not commit is
    processed again on the next start.
    """
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


def landing_stream(spark: SparkSession, landing: str, source: LandingSource,
                   files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New files of a landing folder, one row per array element.

    (element VARIANT, broken, source_file): the record as it came, of any shape. A
    file with one object is one element, an empty array none; text that is no JSON
    is one element that is null, with the text as ``broken``. No schema is declared or
    taken from the files: that is left to those who read Bronze.
    """
    parsed = F.try_parse_json("value")
    elements = F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed))
    # Beside the explode, the text would go with every element and be parsed again for each.
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", ANY_AGE)
             .load(f"{landing}/{source.prefix}")
             .select(F.when(parsed.isNull(), F.col("value")).alias("broken"),
                     F.col("_metadata.file_path").alias("source_file"), elements.alias("elements")))
    return files.select("broken", "source_file", F.explode("elements").alias("element"))


def landed_records(elements: DataFrame, schema_key: str | None, run_id: str, now: Column | None = None) -> DataFrame:
    """(line, errors, message, source_file) of landed elements.

    ``line`` is the whole record with its tags, as JSON: every field it came with,
    declared or not, nested or not. Numbers and text are kept as JSON has them. An
    element that is no object, or lacks a required field, has errors.
    """
    fields_of = F.try_variant_get("element", "$", "map<string,variant>")
    required = REQUIRED.get(schema_key, ())
    told = elements.withColumn("_fields", fields_of).select(
        "*", *[F.try_variant_get(F.col("_fields")[c], "$", "string").alias(c) for c in {*required, "ingested_at"}])
    checked = validated(told, schema_key, run_id, F.col("source_file"), now)
    tags = ("batch_id", "ingested_at", "source_file")
    kept = F.map_filter("_fields", lambda name, _: ~name.isin(*tags))
    tagged = F.map_concat(kept, F.map_from_arrays(
        F.array(*map(F.lit, tags)), F.array(*[F.col(t).cast("variant") for t in tags])))
    whole = F.when(F.col("_fields").isNull(), F.array(F.lit(NO_OBJECT))).otherwise(F.array().cast("array<string>"))
    found = checked.withColumn("errors", F.concat(whole, "errors"))
    told = F.coalesce(F.to_json("element"), "broken")
    return found.select(
        F.when(is_valid(), F.to_json(tagged)).alias("line"), "errors",
        F.when(~is_valid(), told).alias("message"), "source_file")


def _store_landed(checked: DataFrame, bronze: str, source: LandingSource, load: str, counters: Counters,
                  dry_run: bool) -> None:
    bad = checked.filter(~is_valid())
    if dry_run:
        rejected = bad.count()
        written = checked.count() - rejected
    else:
        written = write_lines(checked.filter(is_valid()).select("line"), f"{bronze}/{source.path}", load)
        letters = dead_letter(bad, source.prefix, F.array_join("errors", "; "), message=F.col("message"))
        rejected = write_raw(letters, f"{bronze}/_dead_letters/{source.path}", load=load)
    counters.records_written += written
    counters.records_rejected += rejected
    counters.records_read += written + rejected


def ingest_new_files(spark: SparkSession, source: LandingSource, landing: str, bronze: str,
                     checkpoint: str, run_id: str, reprocess: bool = False,
                     dry_run: bool = False, files_per_batch: int = FILES_PER_BATCH) -> Counters:
    """Ingest the files the checkpoint has not seen, then return.

    The checkpoint is the list of processed files, so a rerun finds nothing to
    do. ``reprocess`` and ``dry_run`` use a checkpoint of their own and leave
    that list alone.
    """
    counters = Counters()
    own = checkpoint if not (reprocess or dry_run) else work_dir(spark, "reprocess")

    def write(batch: DataFrame, epoch: int) -> None:
        checked = landed_records(batch, source.schema_key, run_id).persist()  # parsed once
        try:
            _store_landed(checked, bronze, source, load_name(own, epoch), counters, dry_run)
            counters.files_processed += checked.select("source_file").distinct().count()
        finally:
            checked.unpersist()

    query = (landing_stream(spark, landing, source, files_per_batch)
             .writeStream.queryName(f"landing-{source.path}-{run_id}")
             .option("checkpointLocation", own)
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()
    return counters


def ingest_landing(spark: SparkSession, landing: str, bronze: str, state: str,
                   sources: Sequence[str] | None = None, reprocess: bool = False,
                   dry_run: bool = False) -> DataFrame:
    """Ingest the new files of all landing folders, or those of some sources.

    ``state`` holds one checkpoint per folder. Returns the run summary as one
    row and, unless it is a dry run, appends it to the run log in Bronze.
    Unknown source names and folders that do not exist yet are skipped.
    """
    run_id, began = str(uuid.uuid4()), datetime.now(timezone.utc)
    total = Counters()
    for source in LANDING:
        if sources is not None and source.source not in sources:
            continue
        if not path_exists(spark, f"{landing}/{source.prefix}"):
            continue
        done = ingest_new_files(spark, source, landing, bronze, f"{state}/{source.path}", run_id,
                                reprocess, dry_run)
        total = Counters(*[getattr(total, f.name) + getattr(done, f.name) for f in fields(Counters)])
    summary = run_summary(spark, run_id, "landing_ingest", "landing", began, total.records_read,
                          total.records_written, total.records_rejected, total.files_processed)
    if not dry_run:
        append_run_log(summary, f"{bronze}/_runs")
    return summary
