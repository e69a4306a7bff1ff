"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedforge.session import pin_utc
from feedforge.sources.workdir import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SCHEMAS: dict[tuple[str, str], T.StructType] = {}
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Tables:
    """The given tables as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.written: dict[str, DataFrame] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A derived table as a pipeline would find it: written, then read.

        Its size is then known to the planner from the files. Within one query
        a name is written once.
        """
        if name not in self.written:
            path = work_dir(self.spark, name)
            df.write.parquet(path)
            self.written[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.written[name]

    def __getattr__(self, name: str) -> DataFrame:
        """A given table; its schema is read from the file once per application."""
        path = f"{self.folder}/{name}.parquet"
        known = (self.spark.sparkContext.applicationId, path)
        if known not in SCHEMAS:
            SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[known]).parquet(path)


def plain(df: DataFrame) -> DataFrame:
    """Columns in types that print alike in every engine: whole numbers as
    bigint, dates and timestamps as text, arrays as comma-separated text."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, STAMP_FORMAT)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def query(name: str, sql: str | None = None):
    """Register a ``Tables -> DataFrame`` function under a name."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(fn(Tables(pin_utc(spark), folder)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
