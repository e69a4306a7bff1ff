"""Quality classifier: regularised quadratic discriminant over text statistics.

Every whole text is turned into transformed statistics. Each class is a normal
density whose covariance is shrunk towards the pooled covariance and its
diagonal (Friedman, "Regularized Discriminant Analysis", 1989). A score is the
logistic of the difference of the two log densities, whose Mahalanobis terms use
Cholesky factors computed once. Statistics of very short texts are drawn towards
the mean of the labelled texts first.

Fitting needs the sums of x and of x xT per class only: every labelled row of
the training folds counts, and what reaches the driver is a few hundred
numbers.

Defined results: null and empty texts are scored from the statistics of the
empty text. Labels other than 0 and 1 are left out, and so are documents with
contradicting labels; repeated labels count once. Repeated documents are scored
each. A row with a null id is scored, not learned from, and not held out.
Without labelled rows every score is 0.5; with one class only it is that class.
Further columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, id_fold, map_batches, ship, stored

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#$%&*+=@^_~<>{}[]\\/`"
STEADY_WORDS = 10
STATISTICS = (
    "words", "word_length", "distinct", "repeats", "top_word", "upper", "digits", "symbols",
    "bangs", "bars", "stops", "line_words", "same_lines", "wide", "packed", "short", "marked",
)


def share(part: float, whole: float) -> float:
    """Log of a share, bounded below so that nothing is minus infinity."""
    return math.log(part / whole + 1e-3) if whole else math.log(1e-3)


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text, in the order of STATISTICS."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    held = lambda kinds: size - len(text.translate(None, kinds))
    return [
        math.log1p(n),
        math.log1p(sum(map(len, words)) / n) if n else 0.0,
        math.log1p(len(counts)) / math.log1p(n) if n else 1.0,
        share(sum(map(bytes.__eq__, words, words[1:])), n),
        share(max(counts.values(), default=0), n),
        share(held(UPPER), size),
        share(held(DIGITS), size),
        share(held(SYMBOLS), size),
        share(text.count(b"!"), size),
        share(text.count(b"|"), size),
        share(text.count(b".") + text.count(b"?"), n),
        math.log1p(n / len(lines)) if lines else 0.0,
        share(len(lines) - len(set(lines)), len(lines)),
        share(size - len(text.decode("utf-8", "replace")), size),
        math.log((len(zlib.compress(text, 1)) + 1) / (size + 16)),
        share(sum(len(w) < 4 for w in words), n),
        share(sum(w.endswith((b"!", b"*", b"#", b"%", b"$", b"&")) for w in words), n),
    ]


def text_statistics(documents: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, x): one vector per document, and the hash of its text."""
    ship(documents.sparkSession)

    def run(batch: pa.RecordBatch):
        x = [statistics(t) for t in column_bytes(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "text_key", "x"])

    chosen = documents.select(F.col(id_column).cast("long").alias("doc_id"),
                              F.xxhash64(text_column).alias("text_key"), F.col(text_column).alias("text"))
    return map_batches(chosen, run, "doc_id long, text_key long, x array<double>")


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, log priors, centre."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    priors: list[float]
    centre: np.ndarray

    def log_density(self, k: int, x: np.ndarray) -> np.ndarray:
        factor = self.factors[k]
        z = np.linalg.solve(factor, (x - self.means[k]).T)
        return self.priors[k] - 0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        n = [math.exp(p) for p in self.priors]
        if min(n) == 0:  # a class was never seen
            return np.full(len(x), 0.5 if max(n) == 0 else float(n[1] > 0))
        x = steadied(x, self.centre)
        gap = np.clip(self.log_density(1, x) - self.log_density(0, x), -500, 500)
        return 1 / (1 + np.exp(-gap))


def steadied(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Statistics of few words are noisy: draw them towards the centre.

    A text of n words counts with n / (n + STEADY_WORDS) of its own value; the
    number of words itself stays.
    """
    n = np.expm1(x[:, :1])
    out = centre + (x - centre) * (n / (n + STEADY_WORDS))
    out[:, 0] = x[:, 0]
    return out


def fit(labelled: DataFrame, shrink_pooled: float = 0.1, shrink_diagonal: float = 0.05,
        floor: float = 0.02) -> Discriminant:
    """Fit from (quality, x) rows.

    The covariance of a class is (1 - shrink_diagonal) times a blend of its own
    and the pooled covariance, plus shrink_diagonal times the pooled diagonal,
    plus ``floor`` squared on the diagonal for statistics that never vary.
    """
    d = len(STATISTICS)
    at = labelled.select(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)]).first()
    centre = np.array([v or 0.0 for v in at])

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {0: np.zeros((d + 1, d + 1)), 1: np.zeros((d + 1, d + 1))}
        for frame in frames:
            for k, part in frame.groupby("quality"):
                x = steadied(np.vstack(part["x"].to_numpy()), centre)
                x = np.column_stack([np.ones(len(part)), x])
                total[int(k)] += x.T @ x
        for k, m in total.items():
            if m[0, 0]:
                i, j = np.indices(m.shape).reshape(2, -1)
                yield pd.DataFrame({"k": k, "i": i, "j": j, "v": m.ravel()})

    parts = labelled.select("quality", "x").mapInPandas(sums, "k int, i int, j int, v double")
    rows = parts.groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros((2, d + 1, d + 1))
    for r in rows:  # 2 (d + 1)^2 numbers
        moments[r.k, r.i, r.j] = r.v
    n = moments[:, 0, 0]
    priors = [math.log(c / n.sum()) if c else -math.inf for c in n]
    means = [m[0, 1:] / max(m[0, 0], 1) for m in moments]
    own = [m[1:, 1:] / max(m[0, 0], 1) - np.outer(u, u) for m, u in zip(moments, means)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / max(n.sum(), 1)
    factors = []
    for s in own:
        blend = (1 - shrink_pooled) * s + shrink_pooled * pooled
        full = (1 - shrink_diagonal) * blend + shrink_diagonal * np.diag(np.diag(pooled))
        factors.append(np.linalg.cholesky((full + full.T) / 2 + floor ** 2 * np.eye(d)))
    return Discriminant(means, factors, priors, centre)


def clean_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): one row per document whose labels agree."""
    return (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("most"))
            .where("quality = most").drop("most"))


def score_quality(documents: DataFrame, labels: DataFrame, folds: int = 3,
                  held_out_fold: int = 1, **shrinkage: float) -> DataFrame:
    """(doc_id, held_out, score, predicted, text_key) of every document.

    Documents of the held-out fold take no part in the fit. ``text_key`` is the
    hash of the text, which tells rows that share an id apart.
    """
    x = stored(text_statistics(documents), "quality-statistics").withColumn(
        "held_out", F.coalesce(id_fold("doc_id", folds) == held_out_fold, F.lit(False)))
    model = fit(x.where(~F.col("held_out")).join(clean_labels(labels), "doc_id"), **shrinkage)

    def run(batch: pa.RecordBatch):
        vectors = np.array(batch.column(1).to_pylist(), dtype=float)
        score = model.score(vectors)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(score),
             pa.array((score >= 0.5).astype(np.int32)), batch.column(3)],
            ["doc_id", "held_out", "score", "predicted", "text_key"])

    return map_batches(x.select("doc_id", "x", "held_out", "text_key"), run,
                       "doc_id long, held_out boolean, score double, predicted int, text_key long")
