"""Benchmark decontamination by SimHash over item-sized windows.

A window of a document has as many words as the benchmark item it is held
against. Windows and items have 64-bit SimHashes of their five-word shingles.
Item fingerprints are kept in a multi-index: BLOCKS blocks of 16 bits, each listing
the items whose block is within RADIUS / BLOCKS bits of a value. By the pigeonhole
principle it finds all items within RADIUS bits of a window. Candidates are
verified by the exact weighted Jaccard similarity of their shingles (weight: number
of occurrences), 0.8 or more.

A window that shares no shingle with any item has similarity 0, so fingerprints
are made only for windows around shared shingles. An item that is similar at 0.8
has an expected distance of 10 bits, sd 3; RADIUS 16 loses under 1 % of those at
that very limit.

Items go out in blocks of bounded size (BLOCK_ITEMS, BLOCK_WORDS); each block is one
pass over the documents, which are never shuffled.

Defined results: words are compared without case and without what is no letter or
digit. Null or empty texts and items match nothing. An item of under five words is
one shingle; a document shorter than an item is one window. Repeated rows are
matched each; items that share an id are matched each, and the best match of an id
counts. Null ids are kept in matches. Ties go to the first window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, column_bytes, map_batches, ship

SHINGLE = 5
SIMILAR = 0.8
BLOCKS = 4
RADIUS = 16
BLOCK_ITEMS = 1000
BLOCK_WORDS = 500_000
MAP_BITS = 20
NEAR = np.array([sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(16), k)])


class PlainWords(WordHashes):
    """Word to the hash of its letters and digits, 0 if it has none."""

    def __missing__(self, word: bytes) -> int:
        plain = "".join(c for c in word.decode("utf-8", "replace").casefold() if c.isalnum())
        if len(self) >= 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(plain) or 1 if plain else 0
        return value


WORDS = PlainWords()


def word_hashes(text: bytes | None) -> np.ndarray:
    h = WORDS.of((text or b"").split())
    return h[h != 0]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, bits well mixed."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    x = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        x = x * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def simhashes(marks: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of ``size`` shingles from each start."""
    low = int(starts.min())
    part = marks[low:int(starts.max()) + size]
    bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(part) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[starts - low + size] - total[starts - low]
    return np.packbits(2 * ones > size, axis=1).reshape(-1, 8).view(">u8").ravel().astype(np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingles."""
    one, two = Counter(a.tolist()), Counter(b.tolist())
    both = sum((one & two).values())
    whole = len(a) + len(b) - both
    return both / whole if whole else 0.0


class ItemIndex:
    """Fingerprints of a block of items, by size and by multi-index."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        texts = [(i, word_hashes(t)) for i, t in items]
        self.items = [(i, w) for i, w in texts if len(w)]
        self.sizes = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.widths = np.minimum(self.sizes, SHINGLE)
        self.marks = [shingles(w, min(len(w), SHINGLE)) for _, w in self.items]
        self.prints = np.array([simhashes(m, np.zeros(1, np.int64), len(m))[0] for m in self.marks], dtype=np.uint64)
        keys, owners = [], []
        for b in range(BLOCKS):
            value = (self.prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)
            keys.append(((value[:, None] ^ NEAR) + (b << 16)).ravel())
            owners.append(np.repeat(np.arange(len(self.items)), len(NEAR)))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        self.owner = owner[np.argsort(key, kind="stable")].astype(np.int32)
        self.offset = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=BLOCKS << 16))])
        self.shared = {}  # width -> (sorted shingles, bitmap, items by shingle)
        for width in np.unique(self.widths).tolist():
            own = [k for k in range(len(self.items)) if self.widths[k] == width]
            value = np.concatenate([self.marks[k] for k in own])
            item = np.repeat(own, [len(self.marks[k]) for k in own])
            order = np.argsort(value, kind="stable")
            bitmap = np.zeros(1 << MAP_BITS, dtype=bool)
            bitmap[(value >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True
            self.shared[width] = value[order], bitmap, item[order]

    def candidates(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all items of that size within RADIUS bits."""
        found = []
        for b in range(BLOCKS):
            key = (prints >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64) + (b << 16)
            low, n = self.offset[key], self.offset[key + 1] - self.offset[key]
            window = np.repeat(np.arange(len(prints)), n)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.owner[low[window] + inner]
            ok = self.sizes[item] == size
            found.append(window[ok] * len(self.items) + item[ok])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.items), pairs % len(self.items)
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near], item[near]

    def matches(self, text: bytes | None) -> list[tuple[int | None, int, int, float]]:
        """(item, first word, words, similarity): the best window of every item."""
        words = word_hashes(text)
        best: dict[int, tuple[float, int, int]] = {}
        for width, (value, bitmap, item) in self.shared.items():
            marks = shingles(words, width)
            maybe = np.flatnonzero(bitmap[(marks >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
            low = np.searchsorted(value, marks[maybe], side="left")
            n = np.searchsorted(value, marks[maybe], side="right") - low
            if not n.sum():
                continue
            hit = np.repeat(maybe, n)
            owner = item[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            for size in np.unique(self.sizes[owner]).tolist():
                at = np.unique(hit[self.sizes[owner] == size])
                long = min(size, len(words))  # words of a window
                reach = long - width  # shingles before the last
                edge = np.zeros(len(words) + 2, dtype=np.int64)
                np.add.at(edge, np.maximum(at - reach, 0), 1)
                np.add.at(edge, np.minimum(at, len(words) - long) + 1, -1)
                starts = np.flatnonzero(np.cumsum(edge)[:len(words) - long + 1] > 0)
                if not len(starts):
                    continue
                window, found = self.candidates(simhashes(marks, starts, reach + 1), size)
                for w, k in zip(window.tolist(), found.tolist()):
                    if k in best and best[k][0] == 1.0:
                        continue
                    s = int(starts[w])
                    like = similarity(marks[s:s + reach + 1], self.marks[k])
                    if like >= SIMILAR and like > best.get(k, (0.0,))[0]:
                        best[k] = like, s, long
        return [(self.items[k][0], s, n, like) for k, (like, s, n) in sorted(best.items())]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """Items in blocks of at most BLOCK_ITEMS items and about BLOCK_WORDS words."""
    block, words = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        text = row[1].encode() if row[1] else None
        block.append((row[0], text))
        words += len(text.split()) if text else 0
        if len(block) >= BLOCK_ITEMS or words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


_INDEXES: dict[int, ItemIndex] = {}


def _index(key: int, items: list) -> ItemIndex:
    """The index of a block, kept by a worker for its tasks."""
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = ItemIndex(items)
    return _INDEXES[key]


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): best match of each pair."""
    spark = ship(documents.sparkSession)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, first_word int, n_words int, similarity double"
    found = spark.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        key = xxhash.xxh64_intdigest(repr(items))
        sent = spark.sparkContext.broadcast(items)  # bounded by BLOCK_ITEMS and BLOCK_WORDS

        def run(batch: pa.RecordBatch, key=key, sent=sent):
            index = _index(key, sent.value)
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch, "text")):
                best: dict = {}
                for item, first, n, like in index.matches(text):
                    if item not in best or like > best[item][-1]:
                        best[item] = (doc_id, item, first, n, like)
                rows.extend(best.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()))],
                ["doc_id", "item_id", "first_word", "n_words", "similarity"])

        found = found.union(map_batches(chosen, run, schema))
    return found
