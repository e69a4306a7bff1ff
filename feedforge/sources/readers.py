"""Scans: raw JSON, landing arrays, day partitions, date ranges."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .markers import exists
from .schemas import raw_schema
from .snapshots import is_snapshot_table, read_snapshot

DAY_COLUMNS = ("year", "month", "day")
DAY_FOLDER = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/")
MAX_RANGE_DAYS = 90  # fixed value: longest range one backfill run may cover


def read_raw(spark: SparkSession, path: str, entity: str, only: tuple[str, ...] | None = None,
             lineage: bool = False) -> DataFrame:
    """NDJSON scan with the declared schema.

    Unknown fields are dropped and malformed lines come back all-null, to be
    removed by the key check. ``only`` narrows the schema at the scan.
    """
    return spark.read.schema(raw_schema(entity, only, lineage)).json(path)


def read_raw_days(spark: SparkSession, root: str, entity: str, start: date, end: date,
                  only: tuple[str, ...] | None = None, lineage: bool = False) -> DataFrame:
    """Days ``start..end`` of a Hive-partitioned raw table, in one scan.

    The day columns are kept (writers reuse them as partitions); deeper ones
    such as the hour are left out. Only the folders of the days are listed, so
    the scan does not depend on how many days or loads the table has. Days
    without a folder, and sources that never delivered anything, are empty.
    """
    schema = raw_schema(entity, only, lineage)
    full = T.StructType(schema.fields + [T.StructField(c, T.IntegerType()) for c in DAY_COLUMNS])
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    folders = [f for f in (day_folder(root, d) for d in days) if exists(spark, f)]
    table = spark.read.schema(full).option("basePath", root).json(folders) if folders \
        else spark.createDataFrame([], full)
    return table.filter(days_between(start, end)).select(*schema.fieldNames(), *DAY_COLUMNS)


def day_folder(root: str, day: date) -> str:
    """Where the raw records of one day of ingestion lie."""
    return f"{root}/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def days_of(paths: Iterable[str]) -> list[date]:
    """The days whose folders (see ``day_folder``) hold the given files, in order."""
    folders = {found[-1] for found in map(DAY_FOLDER.findall, paths) if found}
    return sorted(date(*map(int, f)) for f in folders)


def read_landing_array(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Landing files holding one JSON array each; one row per element."""
    return spark.read.schema(raw_schema(entity)).option("multiLine", True).json(path)


def read_table(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """Parquet table, optionally narrowed to some columns; of a table with commits, the newest version."""
    if is_snapshot_table(spark, root):
        return read_snapshot(spark, root, *columns)
    df = spark.read.parquet(root)
    return df.select(*columns) if columns else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything to read at a path."""
    return exists(spark, path)


def days_between(start: date, end: date) -> Column:
    """Partition filter for ``start..end``.

    Made only of comparisons between partition columns and constants, grouped by
    whole months, so that file listings can be pruned with it.
    """
    keep = F.lit(False)
    first = start
    while first <= end:
        next_month = (first.replace(day=1) + timedelta(days=32)).replace(day=1)
        last = min(end, next_month - timedelta(days=1))
        month = (F.col("year") == first.year) & (F.col("month") == first.month)
        keep = keep | (month & F.col("day").between(first.day, last.day))
        first = next_month
    return keep


def check_range(start: date | str, end: date | str, max_days: int = MAX_RANGE_DAYS) -> tuple[date, date]:
    """Both ends given, in order, and at most ``max_days`` apart (inclusive)."""
    if not start or not end:
        raise ValueError("a backfill needs both a start and an end date")
    first, last = (d if isinstance(d, date) else date.fromisoformat(d) for d in (start, end))
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    span = (last - first).days + 1
    if span > max_days:
        raise ValueError(f"{span} days requested, at most {max_days} per run")
    return first, last


def backfill_range(df: DataFrame, day_column: str, start: date | str, end: date | str,
                   max_days: int = MAX_RANGE_DAYS) -> DataFrame:
    """Rows of ``start..end`` (inclusive) in one scan.

    The bounds are compared with the column itself, not with a cast of it, so
    the filter reaches the Parquet row groups for date and timestamp columns.
    """
    first, last = check_range(start, end, max_days)
    kind = df.schema[day_column].dataType
    low, past = (F.lit(d.isoformat()).cast(kind) for d in (first, last + timedelta(days=1)))
    return df.filter((F.col(day_column) >= low) & (F.col(day_column) < past))


def missing_days(df: DataFrame, day_column: str, start: date, end: date) -> DataFrame:
    """Days of ``start..end`` without a single row."""
    span = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("missing_day"))
    present = df.select(F.to_date(day_column).alias("missing_day")).distinct()
    return span.join(present, "missing_day", "left_anti")
