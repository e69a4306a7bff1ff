"""SimHash near-duplicates by covering codes.

Anchors are the words of a covering code: the direct sum of two perfect binary
Golay codes of length 23 on bits 0-22 and 23-45, and of the code {0} on the
other 18 bits. Every half has one anchor within 3 bits, its home. If two
fingerprints differ in at most t bits, of which e1 and e2 in the halves, then the
second is within 3 + e1 and 3 + e2 of the home of the first. So every distinct
fingerprint is replicated to all anchors within that distance (about 300 for
t = 3, whatever the number of rows), meets the fingerprints at home there in an
equality join, and is compared exactly. A fingerprint finds at most 43,744
others within 3 bits, so links do not grow with the square of a group.

Fingerprints at an odd distance have different parities, so the even one alone
needs to be replicated that far: if t is odd, the odd ones go only as far as
t - 1 asks (about 60 anchors for t = 3).

Exact copies share a fingerprint and are one row in the search.

Defined results: a null or empty text has fingerprint 0 and is linked like any
other. Repeated rows are returned as often. A null id takes no part in the
smallest id; a group without any id has a null component. An empty table gives
an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, column_bytes, map_batches, ship, stored
from .components import components

SHINGLE = 3
SEED = 42
HALF = 23
GOLAY = 0b110001110101  # fixed: generator polynomial of the perfect Golay code
COVERING = 3
REPLICATE_CHUNK = 2000
BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of a whole text; a bit is set if over half the hashes set it."""
    words = ascii_words(text)
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    table = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8)
    n = len(table)
    ones = np.concatenate([np.bincount(table[:, i], minlength=256) @ BITS_OF_BYTE for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(documents: DataFrame, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    ship(documents.sparkSession)

    def run(batch: pa.RecordBatch):
        fp = np.array([fingerprint(t) for t in column_bytes(batch, text_column)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(id_column)).cast(pa.int64()),
             pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    chosen = documents.select(F.col(id_column).cast("long").alias(id_column), text_column)
    return map_batches(chosen, run, "doc_id long, fp long")


def _syndrome(word: int) -> int:
    for bit in range(HALF - 1, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


@lru_cache(maxsize=4)
def _cosets(reach: int):
    """Syndrome tables of half words, and per level the error patterns by syndrome.

    Level 0 is the home anchor (within 3 bits); level e are anchors at 3 + e.
    """
    single = np.array([_syndrome(1 << b) for b in range(HALF)])
    table = np.zeros(1 << HALF, dtype=np.int16)
    for b in range(HALF):
        table[1 << b:2 << b] = table[:1 << b] ^ single[b]
    levels = []
    for level in range(reach + 1):
        weights = range(COVERING + 1) if level == 0 else [COVERING + level]
        masks = np.array([sum(1 << b for b in c) for w in weights for c in combinations(range(HALF), w)])
        marks = table[masks]
        order = np.argsort(marks, kind="stable")
        counts = np.bincount(marks, minlength=2048)
        levels.append((masks[order], np.cumsum(counts) - counts, counts))
    return table, levels


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << HALF) - 1
    return fp & mask, fp >> HALF & mask


def home_anchors(fp: np.ndarray) -> np.ndarray:
    """Number of the nearest anchor (24 bits)."""
    return anchors_within(fp, 0)[1]


def anchors_within(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for all anchors that can be home to something within ``threshold``."""
    table, levels = _cosets(threshold)
    first, second = _halves(fp)
    s1, s2 = table[first], table[second]
    rows, anchors = [], []
    for e1 in range(threshold + 1):
        masks1, start1, count1 = levels[e1]
        for e2 in range(threshold + 1 - e1):
            masks2, start2, count2 = levels[e2]
            per = count1[s1] * count2[s2]
            row = np.repeat(np.arange(len(fp)), per)
            inner = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            wide = count2[s2][row]
            a = first[row] ^ masks1[start1[s1][row] + inner // np.maximum(wide, 1)]
            b = second[row] ^ masks2[start2[s2][row] + inner % np.maximum(wide, 1)]
            rows.append(row)
            anchors.append((a >> 11) << 12 | b >> 11)
    return np.concatenate(rows), np.concatenate(anchors)


def _replicated(distinct: DataFrame, even: int, odd: int) -> DataFrame:
    """(anchor, fp): fingerprints at every anchor in reach; home only for 0.

    ``even`` and ``odd`` are the thresholds of fingerprints of that parity.
    """

    def run(batch: pa.RecordBatch):
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        is_odd = np.bitwise_count(fp.view(np.uint64)) % 2 == 1
        for some, threshold in ((fp[~is_odd], even), (fp[is_odd], odd)):
            for at in range(0, len(some), REPLICATE_CHUNK):
                part = some[at:at + REPLICATE_CHUNK]
                row, anchor = anchors_within(part, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(part[row])], ["anchor", "fp"])

    return map_batches(distinct.select("fp"), run, "anchor int, fp long")


def links_within(distinct: DataFrame, threshold: int = 3) -> DataFrame:
    """(u, v) with u < v: all pairs of distinct fingerprints within ``threshold`` bits.

    Each is found once: at an even distance with the larger one replicated, at an
    odd distance with the one of even parity. The planner sizes the anchors as the
    fingerprints they come from, hundreds of times too low, so it may not broadcast them.
    """
    home = _replicated(distinct, 0, 0).select("anchor", F.col("fp").alias("u"))
    away = _replicated(distinct, threshold, threshold - threshold % 2).select("anchor", F.col("fp").alias("v"))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    once = F.when(apart % 2 == 0, F.col("u") < F.col("v")).otherwise(F.bit_count("v") % 2 == 0)
    return home.join(away.hint("merge"), "anchor").where((apart <= threshold) & once).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def near_duplicates(documents: DataFrame, threshold: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    fps = stored(fingerprints(documents), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links_within(distinct, threshold))
    roots = stored(roots.join(distinct, roots.node == distinct.fp).select("fp", "root", "first"), "roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    joined = roots.join(least, "root").select("fp", "component_id")
    named = distinct.join(joined, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id"))
    named = stored(named, "named")  # read from files, so that a hot fingerprint can be split in the join
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
