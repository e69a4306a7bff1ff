"""Substring dedup over sliding spans of sentences.

A span is a run of consecutive sentences: from every sentence on, and up to every
sentence, the shortest run of at least two sentences and ``min_words`` words; a
sentence of ``long_words`` words is a span by itself. Longer runs are unions of
these, so with ``min_words=1`` every repeated run of two or more sentences is
found. All spans are hashed and joined globally. The first occurrence of a span,
by doc_id and position, stays; sentences that any other occurrence covers are
removed, in all documents.

Hashes are counted with map-side aggregates first, so a span that a third of all
documents hold is one row per task there; the join back is an equality join whose
hot keys adaptive execution splits. Only the repeated spans are joined further.

Defined results: sentences end after . ! ? and white space, after their full-width
forms, and at line breaks; white space stays with the sentence before it. Words
compare without case. A null text stays null, an empty one empty; both have no
spans. A document is known by its id and the hash of its text: rows that share an
id but not a text are documents of their own, in the order of the hashes; rows that
share both count as one and lose the same sentences. Documents without an id come
after all others. A document that loses every sentence stays, with an empty text.
Other columns are kept as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, stored

MIN_WORDS = 20
LONG_WORDS = 30
ENDS = re.compile(r"[.!?]+\s+|[。！？]+\s*|\n\s*")
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def sentences(text: str) -> list[str]:
    """The text cut after every sentence; joined they are the text."""
    cuts = [0, *(m.end() for m in ENDS.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def spans(text: str | None, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, number of sentences) of all spans of a text."""
    words = [s.lower().split() for s in sentences(text or "")]
    n = len(words)
    none = np.empty(0, dtype=np.int64)
    if not n:
        return none, none, none
    h = np.fromiter((xxhash.xxh64_intdigest(" ".join(w)) for w in words), dtype=np.uint64, count=n)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    total = np.concatenate([[0], np.cumsum(size)])
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, STEP)]), dtype=np.uint64)
    undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BACK)]), dtype=np.uint64)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:n], dtype=np.uint64)])
    at = np.arange(n)
    ahead = np.maximum(np.searchsorted(total, total[:-1] + min_words), at + 2)  # end of the run from a sentence
    back = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right") - 1, at - 1)  # begin up to one
    long = at[size >= long_words]
    first = np.concatenate([at[ahead <= n], back[back >= 0], long])
    end = np.concatenate([ahead[ahead <= n], at[back >= 0] + 1, long + 1])
    pairs = np.unique(first * (n + 1) + end)
    first, end = pairs // (n + 1), pairs % (n + 1)
    mixed = (prefix[end] - prefix[first]) * undo[first]
    mixed ^= (end - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed.view(np.int64), first, end - first


def document_spans(documents: DataFrame, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """(hash, doc_id, text_key, first, size) of every document."""
    ship(documents.sparkSession)

    def run(batch: pa.RecordBatch):
        parts = [spans(t, min_words, long_words) for t in batch.column(2).to_pylist()]
        hashes, first, size = (np.concatenate([p[i] for p in parts]) for i in range(3))
        row = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes), batch.column(0).take(row), batch.column(1).take(row),
             pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))],
            ["hash", "doc_id", "text_key", "first", "size"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return map_batches(chosen, run, "hash long, doc_id long, text_key long, first int, size int")


def repeated_sentences(documents: DataFrame, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, text_key, covered): spans (first, size) of a document that occurred before."""
    found = stored(document_spans(documents, min_words, long_words), "spans")
    # Aggregates are read from files, so that joins can split a hot hash.
    often = stored(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "often")
    hits = stored(found.join(often, "hash"), "repeated-spans")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "first")
    origin = stored(hits.groupBy("hash").agg(F.min(place).alias("origin")), "origins")
    later = hits.join(origin, "hash").where(place > F.col("origin"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "size")).alias("covered"))


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """The documents with text cut; n_sentences and n_removed are added.

    Names that the input has already are replaced.
    """
    ship(documents.sparkSession)
    own = [c for c in documents.columns if c not in ("n_sentences", "n_removed", "_covered")]
    covered = repeated_sentences(documents, min_words, long_words).withColumnRenamed("covered", "_covered").alias("c")
    same = F.expr("d.doc_id <=> c.doc_id and xxhash64(d.text) = c.text_key")
    joined = documents.select(*own).alias("d").join(covered, same, "left").select("d.*", "c._covered")
    at = own.index("text")

    def run(batch: pa.RecordBatch):
        texts, counts, gone = [], [], []
        for text, cut in zip(batch.column(at).to_pylist(), batch.column(len(own)).to_pylist()):
            parts = sentences(text or "")
            drop = {i for c in cut or () for i in range(c["first"], c["first"] + c["size"])}
            kept = [s for i, s in enumerate(parts) if i not in drop]
            texts.append("".join(kept) if drop else text)
            counts.append(len(parts))
            gone.append(len(parts) - len(kept))
        columns = [batch.column(i) for i in range(len(own))]
        columns[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], [*own, "n_sentences", "n_removed"])

    fields = [f for f in joined.schema.fields if f.name in own]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_sentences long, n_removed long"
    return map_batches(joined, run, schema)
