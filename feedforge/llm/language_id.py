"""Language identification as a mixture of languages.

A document is a mixture of languages, each a distribution over letter trigrams.
Expectation-maximisation finds the proportions of the mixture from the trigram
likelihoods; the set of languages is chosen among the nested sets of the largest
proportions by penalised likelihood. The prediction is the language with the
largest proportion.

Trigrams are hashed into BUCKETS buckets. Every labelled training document counts
with its whole text; counts are summed per task before the shuffle, and what is
collected is languages x BUCKETS numbers, whatever the input.

Defined results: a null text or one without a letter is ``und`` with score 0 and
no proportions. Documents with a null language or a null id are not learned from;
a null id is not held out. Without a training document everything is ``und``.
Ties go to the language first in the alphabet. Repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, id_fold, map_batches, ship

BUCKETS = 1 << 15
SMOOTHING = 0.1
ROUNDS = 15
CLOSE = 1e-3
# Neighbouring trigrams share letters: about every third is new evidence.
OVERLAP = 3.0
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for code points of letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: bytes | None) -> np.ndarray:
    """Buckets of the letter trigrams of a whole text.

    Runs of other characters count as one space; a trigram has a letter in its
    middle. The text is lower-cased.
    """
    if not text:
        return np.empty(0, dtype=np.int64)
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    middle = codes[1:-1]
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + middle) * np.uint64(0x85EBCA77) + codes[2:]
    mixed = (mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(49)
    return mixed[middle != 32].astype(np.int64)


def learn(documents: DataFrame, id_column: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language), shape (languages, BUCKETS)."""
    ship(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            grams: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(column_bytes(batch, "text"), batch.column(1).to_pylist()):
                grams.setdefault(lang, []).append(trigrams(text))
            for lang, found in grams.items():
                seen = np.bincount(np.concatenate(found), minlength=BUCKETS)
                total[lang] = total[lang] + seen if lang in total else seen
        for lang, seen in total.items():
            used = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                 pa.array(seen[used])], ["lang", "bucket", "n"])

    parts = documents.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(
        count, "lang string, bucket int, n long")
    table = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    rows = np.fromiter((place[x] for x in names), dtype=np.int64, count=len(names))
    counts[rows, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    smooth = counts + SMOOTHING
    return languages, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def _mixture(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: proportions and log likelihood; p is (languages, trigrams)."""
    share = np.full(len(p), 1 / len(p))
    for _ in range(ROUNDS if len(p) > 1 else 0):
        joint = share[:, None] * p
        moved = (joint / joint.sum(axis=0)) @ counts / counts.sum()
        done = np.abs(moved - share).max() < CLOSE
        share = moved
        if done:
            break
    return share, float(np.log(share @ p) @ counts)


def proportions(text: bytes | None, log_p: np.ndarray) -> np.ndarray:
    """Share of every language in a text; all zero if nothing can be said."""
    out = np.zeros(len(log_p))
    grams = trigrams(text)
    if not len(grams) or not len(log_p):
        return out
    used, counts = np.unique(grams, return_counts=True)
    found = log_p[:, used]
    p = np.exp(found - found.max(axis=0))
    price = 0.5 * np.log1p(counts.sum() / OVERLAP) * OVERLAP
    full, _ = _mixture(p, counts)
    order = np.argsort(-full, kind="stable")
    best, chosen = -np.inf, None
    for size in range(1, len(order) + 1):
        share, fit = _mixture(p[order[:size]], counts)
        value = fit - price * (size - 1)
        if value <= best:
            break
        best, chosen = value, (order[:size], share)
    out[chosen[0]] = chosen[1]
    return out


def identify(documents: DataFrame, languages: list[str], log_p: np.ndarray,
             id_column: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, languages): the last maps languages to shares."""
    ship(documents.sparkSession)

    def run(batch: pa.RecordBatch):
        names, scores, sets = [], [], []
        for text in column_bytes(batch, "text"):
            share = proportions(text, log_p)
            top = int(np.argmax(share)) if len(share) else 0
            known = len(share) > 0 and share[top] > 0
            names.append(languages[top] if known else UNDETERMINED)
            scores.append(min(1.0, float(share[top])) if known else 0.0)
            sets.append([(languages[i], float(share[i])) for i in np.flatnonzero(share)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
             pa.array(sets, pa.map_(pa.string(), pa.float64()))],
            ["doc_id", "lang_pred", "score", "languages"])

    chosen = documents.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    return map_batches(chosen, run, "doc_id long, lang_pred string, score double, languages map<string,double>")


def predict_languages(documents: DataFrame, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every document."""
    held = F.coalesce(id_fold("doc_id", folds) == held_out_fold, F.lit(False))
    languages, log_p = learn(documents.where(~held & F.col("doc_id").isNotNull()))
    found = identify(documents, languages, log_p)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages")
