"""Corpus pipeline: from documents to token ids, one operator a stage.

Stages take (spark, docs, sf_dir) and return a DataFrame; ``run`` writes each
result as Parquet in the shared work folder and reads it back for the next one.

Rows are known by their id and the hash of their text, never by the id alone: rows
that share an id but not a text are judged one by one, and so are rows without an
id. Rows that share both are copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedforge.llm import decontamination, piece_codec, quality_classifier, simhash_dedup, substring_dedup
from feedforge.llm.common import stored


def _row_key() -> Column:
    """Hash of id and text."""
    return F.xxhash64("doc_id", "text")


def _decided(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The documents whose key is (left_semi) or is not (left_anti) among ``rows``."""
    same = F.expr("xxhash64(d.doc_id, d.text) = r._row")
    return docs.alias("d").join(rows.alias("r"), same, how).select("d.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = quality_classifier.score_quality(docs, labels).where("predicted = 0")
    own = F.expr("d.doc_id <=> r.doc_id and xxhash64(d.text) = r.text_key")
    return docs.alias("d").join(rejected.alias("r"), own, "left_anti").select("d.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group, once.

    Without any id in a group, and among texts of one id, the smallest hash stays.
    If two texts had the same hash, both would stay.
    """
    groups = simhash_dedup.near_duplicates(docs.select(_row_key().alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = docs.select(_row_key().alias("_row"), F.col("doc_id").cast("long").alias("_id")).distinct()
    place = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_row")
    kept = groups.join(ids, "_row").groupBy("component_id").agg(F.min(place).alias("first"))
    stay = _decided(docs, kept.select("first._row"), "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id", "text").orderBy(F.to_json(F.struct(F.lit(0), *others)))
    copy = "_copy"
    while copy in docs.columns:
        copy += "_"
    return stay.withColumn(copy, F.row_number().over(order)).where(f"{copy} = 1").drop(copy)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut sentences of repeated spans; n_chars follows the text."""
    cut = substring_dedup.without_repeats(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(_row_key().alias("doc_id"), "text")
    found = decontamination.contaminated(keyed, benchmark).select(F.col("doc_id").alias("_row")).distinct()
    return _decided(docs, found, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids and the text decoded from them."""
    encoded = piece_codec.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("encode", encode),
]
#: Discriminants, components and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
