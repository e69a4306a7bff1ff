"""Sinks. Row counts come from the write itself, not from an extra job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedforge.functions.columns import utc_timestamp

from .markers import settled

MAX_RECORDS_PER_FILE = 50_000  # fixed value: longest raw file
RAW_CODEC = "gzip"  # raw JSON repeats its names in every record; readers go by the file name
DAY_COLUMNS = ("year", "month", "day")
HOUR_COLUMNS = (*DAY_COLUMNS, "hour")
HOUR_FOLDERS = {"year": "%Y", "month": "%m", "day": "%d", "hour": "%H"}  # fixed values
RAW_LAYOUT = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}  # fixed values


def with_time_parts(df: DataFrame, ts_column: str, parts: Sequence[str]) -> DataFrame:
    """Add year/month/day(/hour) of a timestamp where they are absent."""
    make = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    absent = {p: make[p](ts_column) for p in parts if p not in df.columns}
    return df.withColumns(absent) if absent else df


def load_folder(spark: SparkSession, path: str, load: str, ingested: datetime | None = None) -> str:
    """The folder of a load: ``path/year=YYYY/month=MM/day=DD/hour=HH/load=<load>``.

    The hour is that of the load's first try, kept in ``path/_loads``, so that a
    repeated try replaces the folder instead of adding one in another hour.
    """
    at = (ingested or datetime.now(timezone.utc)).astimezone(timezone.utc)
    hour = "/".join(f"{part}={at.strftime(shape)}" for part, shape in HOUR_FOLDERS.items())
    return f"{path}/{settled(spark, f'{path}/_loads', load, hour)}/load={load}"


def write_lines(lines: DataFrame, path: str, load: str, max_records: int = MAX_RECORDS_PER_FILE,
                ingested: datetime | None = None) -> int:
    """JSON records that are text already, one a row, into the folder of a load."""
    seen = Observation()
    (lines.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", RAW_CODEC)
     .text(load_folder(lines.sparkSession, path, load, ingested)))
    return seen.get["rows"]


def write_raw(df: DataFrame, path: str, at: str = "ingested_at",
              max_records: int = MAX_RECORDS_PER_FILE, load: str | None = None,
              mode: str = "append", ingested: datetime | None = None, codec: str | None = None) -> int:
    """NDJSON below ``path/year=YYYY/month=MM/day=DD/hour=HH``, bounded file length.

    Loads are compressed, other files if ``codec`` says so.

    With ``load`` the hour is that of ingestion, ``ingested`` or now, whatever the
    records say of their time, and ``load=<load>`` below it is replaced by a
    repeated try of that load. So every row is found again by the day on which it
    came. Without ``load`` the hour is that of the column ``at``.
    """
    shown = {"ignoreNullFields": "false", "maxRecordsPerFile": str(max_records)}
    if codec or load is not None:
        shown["compression"] = codec or RAW_CODEC
    if load is not None:
        seen = Observation()
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**shown)
         .json(load_folder(df.sparkSession, path, load, ingested)))
        return seen.get["rows"]
    is_text = df.schema[at].dataType.simpleString() == "string"
    when = utc_timestamp(at) if is_text else F.col(at).cast("timestamp")
    laid_out = df.withColumns({part: F.date_format(when, shape) for part, shape in RAW_LAYOUT.items()})
    seen = Observation()
    (laid_out.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode(mode).options(**shown).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*HOUR_COLUMNS).json(path))
    return seen.get["rows"]


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str] = DAY_COLUMNS,
                     mode: str = "overwrite", at: str = "ingested_at", rebalance: bool = False) -> int:
    """Partitioned Parquet; overwrite replaces only the partitions it writes.

    ``rebalance`` gathers each output partition into few files before writing
    and still splits a partition that is large; worth its shuffle when one write
    covers many partitions. Returns the rows written.
    """
    derivable = [p for p in partitions if p in HOUR_COLUMNS]
    laid_out = with_time_parts(df, at, derivable) if at in df.columns else df
    if rebalance:
        laid_out = laid_out.hint("rebalance", *[F.col(p) for p in partitions])
    seen = Observation()  # last before the write, where a repeated task counts once
    (laid_out.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))
    return seen.get["rows"]


def replace_table(df: DataFrame, path: str) -> None:
    """Gold tables are rebuilt as a whole (type 1)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_run_log(summary: DataFrame, path: str) -> None:
    """Add a run summary to the log, partitioned by the day the run started."""
    with_time_parts(summary, "started_at", DAY_COLUMNS) \
        .write.mode("append").partitionBy(*DAY_COLUMNS).json(path)


def dry_run(df: DataFrame) -> int:
    """Execute the whole plan, count, write nothing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]
