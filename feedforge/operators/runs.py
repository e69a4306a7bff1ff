"""Run counters as one row, measured by the job that does the work."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedforge.functions.columns import any_null

SUMMARY_SCHEMA = """run_id string, job_name string, source string, started_at timestamp,
    finished_at timestamp, records_read bigint, records_written bigint,
    records_rejected bigint, files_processed bigint"""


LEDGER_SCHEMA = """run_id string, started_at timestamp, entity string, records_read bigint,
    records_rejected bigint, duplicates_removed bigint, records_kept bigint, files_processed bigint"""


def layer_ledger(spark: SparkSession, run_id: str, started_at: datetime,
                 counts: Sequence[tuple[str, int, int, int, int]]) -> DataFrame:
    """One row per entity of a run, from (entity, read, rejected, kept, files).

    What was read is kept, rejected, or a repeated delivery of something kept.
    """
    rows = [(run_id, started_at, entity, read, rejected, read - rejected - kept, kept, files)
            for entity, read, rejected, kept, files in counts]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def layer_counts(raw: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows read, rejected for null keys, left after dedup, and duplicates removed.

    One grouping by the dedup key answers all four, with partial counts before
    the shuffle.
    """
    per_key = raw.groupBy(*keys, any_null(required).alias("_bad")).agg(F.count(F.lit(1)).alias("_n"))
    rejected = F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records_read"),
        rejected.alias("records_rejected"),
        F.count_if(~F.col("_bad")).alias("records_kept"),
    ).withColumn("duplicates_removed",
                 F.col("records_read") - F.col("records_rejected") - F.col("records_kept"))


def run_summary(spark: SparkSession, run_id: str, job: str, source: str, started_at: datetime,
                read: int, written: int, rejected: int, files: int,
                finished_at: datetime | None = None) -> DataFrame:
    """One row describing a finished run, ready to append to the run log."""
    done = finished_at or datetime.now(timezone.utc)
    row = (run_id, job, source, started_at, done, read, written, rejected, files)
    return spark.createDataFrame([row], SUMMARY_SCHEMA)
