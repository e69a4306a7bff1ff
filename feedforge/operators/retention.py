"""Which landing files may go."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP_DAYS = 7  # fixed value: days a processed landing file is kept


def file_manifest(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Path, size and modification time of every file; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))


def processed_files(bronze: DataFrame) -> DataFrame:
    """Files that reached Bronze, from the lineage of its rows."""
    return bronze.select(F.col("source_file").alias("path")).distinct()


def retention_candidates(manifest: DataFrame, processed: DataFrame, as_of: date | Column,
                         keep_days: int = KEEP_DAYS, by: Sequence[str] = ("path",)) -> DataFrame:
    """Files already processed and last changed before the cutoff day.

    ``by`` names what tells the files apart, where that is more or other than their
    path. Only selects; deleting is left to the caller.
    """
    cutoff = F.date_sub(F.lit(as_of).cast("date"), keep_days)
    old = manifest.filter(F.to_date("modificationTime") < cutoff)
    return old.join(processed.select(*by), list(by), "left_semi")
