"""Row-level validation, tagging and normalisation. No shuffle in here."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedforge.functions.columns import any_null, utc_timestamp
from feedforge.sources.schemas import REQUIRED

# Fixed value: wording of a validation error.
MISSING_FIELD = "Required field missing or null: {}"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def reject_split(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by nulls in the required columns."""
    incomplete = any_null(required)
    return df.filter(~incomplete), df.filter(incomplete)


def validate_required(df: DataFrame, entity: str | None, into: str = "errors") -> DataFrame:
    """Add the list of validation errors; an empty list means valid.

    An entity without declared rules passes everything. A required column the
    input does not have counts as missing in every row.
    """
    checks = []
    for name in REQUIRED.get(entity, ()):
        absent = F.col(name).isNull() if name in df.columns else F.lit(True)
        checks.append(F.when(absent, F.lit(MISSING_FIELD.format(name))))
    found = F.filter(F.array(*checks), lambda e: e.isNotNull()) if checks \
        else F.array().cast("array<string>")
    return df.withColumn(into, found)


def tag_metadata(df: DataFrame, run_id: str, source_file: str | Column | None = None,
                 now: Column | None = None) -> DataFrame:
    """Run id, source file and ingestion time of a raw record.

    An ingestion time already on the record is kept.
    """
    stamp = F.date_format(now if now is not None else F.current_timestamp(), ISO_FORMAT)
    tags = {
        "batch_id": F.lit(run_id),
        "ingested_at": F.coalesce(F.col("ingested_at"), stamp) if "ingested_at" in df.columns else stamp,
    }
    if source_file is not None:
        tags["source_file"] = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(tags)


def normalize_ts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Make the listed columns UTC timestamps; columns not in the input are skipped."""
    kinds = dict(df.dtypes)
    read = {
        "string": utc_timestamp,
        "bigint": F.timestamp_seconds,
        "int": F.timestamp_seconds,
    }
    return df.withColumns({
        c: read.get(kinds[c], lambda x: x.cast("timestamp"))(F.col(c))
        for c in columns if c in kinds
    })


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def dead_letter(df: DataFrame, topic: str | Column, error: Column, failed_at: Column | None = None,
                message: Column | None = None) -> DataFrame:
    """Envelope of a rejected record: topic, original message, error, time."""
    body = message if message is not None else F.to_json(F.struct(*df.columns))
    return df.select(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("original_topic"),
        body.alias("original_message"),
        error.alias("error"),
        (failed_at if failed_at is not None else F.current_timestamp()).alias("failed_at"),
    )
