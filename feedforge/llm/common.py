"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedforge.sources.markers import remove
from feedforge.sources.workdir import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MEMO_WORDS = 400_000


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write to a new folder in the shared work folder and read back.

    Cuts the lineage: what is read later survives the loss of executors. With
    ``by``, a filter on those columns reads only its own files.
    """
    path = work_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a table that ``stored`` wrote and nothing reads again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id has a null fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary()).to_pylist()


class WordHashes(dict):
    """Word (bytes) to 64-bit XXH64, kept for the words of one worker.

    A memo only: it is emptied when full and never changes a result.
    """

    def __init__(self, seed: int = 42):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def ascii_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text whose A-Z are lower-cased."""
    return text.lower().split() if text else []


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """Apply a batch function within every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)
