"""Toxicity by multiple-instance learning: documents are labelled, sentences are judged.

A sentence is an instance with a probability, the logistic of a sum of weights of
its words. A document is toxic if any of its sentences is (noisy-or): its score is
1 - prod(1 - p). Weights are trained from document labels alone by the penalised
likelihood of the noisy-or, and then locate the sentences that made a document
toxic.

Fitting uses a bounded sample of labelled training rows: of either label the
``per_class`` documents with the smallest hash of their id, weighted by how many
they stand for. So the sample's ids may be broadcast, and no text is shuffled.
Words and beginnings of words enter the model by their association with the
label, the ``words`` strongest ones. Every step of the optimiser is a Spark job over the stored sample
that returns one gradient a partition. Scoring reads every whole text once.

Defined results: null and empty texts have one empty sentence. Labels other than
0 and 1 are left out, and so are ids with contradicting labels; repeated labels
count once. Repeated documents are scored each. A row with a null id is scored,
not learned from, and not held out. Without labelled training rows every score
is 0.5; with one label only it is that label. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, id_fold, map_batches, ship, stored

#: Ends of sentences.
ENDS = ".!?\n。！？…"
TOKEN = re.compile(rf"[^\W\d_]+|[{ENDS}]")
END = re.compile(rf"[{ENDS}]")
#: Lengths of the beginnings of words that are features beside the word itself.
BEGINNINGS = (4, 5, 6)
PARTS = 32
STEPS = 60


def features(word: str) -> list[int]:
    """63-bit hashes of a word and of its beginnings, which find what is made of a known stem."""
    parts = [word, *(f"{word[:k]}-" for k in BEGINNINGS if len(word) > k)]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 42) >> 1 for p in parts]


class Codes(dict):
    """Token to a number: -1 for the end of a sentence, 0 for nothing known, else a place in ``lists``.

    ``known`` turns the hashes of a word's features into codes. A memo only: it is
    emptied between documents when full, without effect on results.
    """

    def __init__(self, known):
        super().__init__()
        self.known, self.lists = known, [np.zeros(0, np.int64)]

    def __missing__(self, token: str) -> int:
        value = -1
        if token not in ENDS:
            codes = self.known(features(token))
            value = len(self.lists) if len(codes) else 0
            if value:
                self.lists.append(np.array(codes, np.int64))
        self[token] = value
        return value

    def trim(self) -> None:
        if len(self) >= MEMO_WORDS:
            self.clear()
            del self.lists[1:]


def instances(text: str | None, codes: Codes) -> tuple[np.ndarray, np.ndarray, int]:
    """(sentence numbers, codes, number of sentences): the distinct codes of every sentence."""
    codes.trim()
    found = TOKEN.findall((text or "").lower())
    place = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
    number = np.cumsum(place == -1)
    lists = [codes.lists[i] for i in place[place > 0]]
    pairs = np.stack([np.repeat(number[place > 0], [len(x) for x in lists]), np.concatenate([codes.lists[0], *lists])])
    pairs = np.unique(pairs, axis=1)
    return pairs[0], pairs[1], int((place == -1).sum()) + 1


@dataclass
class Model:
    """Hashes of the known words in order, their weights, and the weight of every sentence."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    certain: float | None = None

    def codes(self) -> Codes:
        place = {int(w): i for i, w in enumerate(self.words)}
        return Codes(lambda hashes: [place[h] for h in hashes if h in place])

    def sentences(self, text: str | None, codes: Codes) -> np.ndarray:
        """Probability of every sentence of a text."""
        number, code, n = instances(text, codes)
        z = self.bias + np.bincount(number, self.weights[code], n)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def noisy_or(p: np.ndarray) -> float:
    """Probability that any instance is positive."""
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-16)).sum()))


def loss_and_gradient(x: np.ndarray, toxic: np.ndarray, heft: np.ndarray, n: np.ndarray,
                      number: np.ndarray, code: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of documents, and its gradient; the last entry belongs to the bias.

    ``n`` are the documents' sentences, ``number`` and ``code`` the features over
    all of these sentences. With s the sum of log(1 + exp(z)) over a document's
    sentences, a clean document has loss s and a toxic one -log(1 - exp(-s)).
    """
    z = x[-1] + np.bincount(number, x[code], int(n.sum()))
    s = np.maximum(np.add.reduceat(np.logaddexp(0, z), np.cumsum(n) - n), 1e-12)
    loss = np.where(toxic, -np.log(-np.expm1(-s)), s)
    slope = np.repeat(heft * np.where(toxic, -1 / np.expm1(np.minimum(s, 700)), 1), n) / (1 + np.exp(-np.clip(z, -700, 700)))
    grad = np.bincount(code, slope[number], len(x))
    grad[-1] = slope.sum()
    return float((heft * loss).sum()), grad


def minimised(f, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving; f gives value and gradient."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < steps and np.abs(grad).max() > 1e-4 * max(1.0, abs(value)):
        direction, factors = -grad, []
        for dx, dg in reversed(past):
            a = dx @ direction / (dx @ dg)
            factors.append(a)
            direction = direction - a * dg
        if past:
            direction = direction * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        else:
            direction = direction / max(1.0, np.abs(grad).max())
        for (dx, dg), a in zip(past, reversed(factors)):
            direction = direction + (a - dg @ direction / (dx @ dg)) * dx
        slope, size = grad @ direction, 1.0
        while used < steps:
            new_value, new_grad = f(x + size * direction)
            used += 1
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        dx, dg = size * direction, new_grad - grad
        if dx @ dg > 1e-12:
            past = [*past[1 - memory:], (dx, dg)]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        x, value, grad = x + dx, new_value, new_grad
        if done:
            break
    return x


def clean_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one row per document whose labels agree."""
    return (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most"))
            .where("toxic = most").drop("most"))


def fit(documents: DataFrame, labelled: DataFrame, per_class: int = 25_000, words: int = 4096,
        least_documents: int = 2, penalty: float = 0.1) -> Model:
    """Fit from documents and the labels (doc_id, toxic) of the training folds."""
    nothing = np.array([], dtype=np.int64), np.zeros(0)
    named = labelled.join(documents.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    named = stored(named, "labelled")
    n = {r.toxic: r["count"] for r in named.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model(*nothing, 0.0, 0.5 if not n else float(next(iter(n))))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [named.where(F.col("toxic") == k).orderBy(*order).limit(per_class)
              .withColumn("heft", F.lit(max(1.0, n[k] / per_class))) for k in n]
    # 2 * per_class rows at most.
    sample = F.broadcast(stored(chosen[0].union(chosen[1]), "sample").withColumnRenamed("doc_id", "_id"))
    texts = documents.join(sample, F.col("doc_id").cast("long") == F.col("_id")).select("text", "toxic", "heft")

    def tokens(batch: pa.RecordBatch):
        codes = Codes(lambda hashes: hashes)
        parts = [instances(t, codes) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array([p[0] for p in parts], pa.list_(pa.int64())),
             pa.array([p[1] for p in parts], pa.list_(pa.int64())), pa.array([p[2] for p in parts], pa.int64())],
            ["toxic", "heft", "number", "code", "n"])

    schema = "toxic int, heft double, number array<long>, code array<long>, n long"
    tokenised = stored(map_batches(texts, tokens, schema).repartition(PARTS), "tokens")
    # Log-likelihood ratio of a word and the label, over documents that have it.
    total = {k: float(min(n[k], per_class)) for k in n}
    seen = (tokenised.select("toxic", F.explode(F.array_distinct("code")).alias("word"))
            .groupBy("word").agg(*[F.sum((F.col("toxic") == k).cast("double")).alias(f"n{k}") for k in (0, 1)])
            .where(F.col("n0") + F.col("n1") >= least_documents))
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    ratio = F.lit(0.0)
    for k in (0, 1):
        share = (F.col("n0") + F.col("n1")) / (total[0] + total[1])
        hit, miss = F.col(f"n{k}"), F.greatest(total[k] - F.col(f"n{k}"), F.lit(0.0))
        ratio = ratio + part(hit, total[k] * share) + part(miss, total[k] * (1 - share))
    kept = seen.withColumn("ratio", ratio).orderBy(F.desc("ratio"), "word").limit(words).select("word")
    model = Model(np.sort(np.array([r.word for r in kept.collect()], dtype=np.int64)), np.zeros(0), 0.0)
    model.weights = np.zeros(len(model.words))

    def encoded(batch: pa.RecordBatch):
        numbers, codes = [], []
        for i in range(batch.num_rows):
            value = batch.column(3)[i].values.to_numpy()
            at = np.minimum(np.searchsorted(model.words, value), max(len(model.words) - 1, 0))
            hit = model.words[at] == value if len(model.words) else np.zeros(len(value), bool)
            numbers.append(batch.column(2)[i].values.to_numpy()[hit])
            codes.append(at[hit])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(numbers, pa.list_(pa.int64())),
             pa.array(codes, pa.list_(pa.int64())), batch.column(4)], batch.schema.names)

    train = stored(map_batches(tokenised, encoded, schema), "instances")

    def f(x: np.ndarray) -> tuple[float, np.ndarray]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, grad = 0.0, np.zeros(len(x))
            for batch in batches:
                toxic, heft, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 4))
                number, code = (batch.column(i).flatten().to_numpy() for i in (2, 3))
                held = batch.column(2).value_lengths().to_numpy()
                more = loss_and_gradient(x, toxic == 1, heft, n, number + np.repeat(np.cumsum(n) - n, held), code)
                value, grad = value + more[0], grad + more[1]
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([grad], pa.list_(pa.float64()))], ["value", "grad"])

        rows = train.mapInArrow(partial, "value double, grad array<double>").collect()  # one a partition
        value = sum(r.value for r in rows) + penalty / 2 * float(x[:-1] @ x[:-1])
        return value, sum(np.array(r.grad) for r in rows) + penalty * np.append(x[:-1], 0)

    x = minimised(f, np.append(model.weights, -5.0), STEPS)
    model.weights, model.bias = x[:-1], float(x[-1])
    return model


def score_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0,
                   **options: float) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) of every document.

    ``offending`` lists the sentences (position from 0, score, text) that are
    more likely toxic than not; of a document that is toxic only by the sum of
    its sentences, the likeliest one. Documents of the held-out fold take no part
    in the fit.
    """
    ship(documents.sparkSession)
    training = clean_labels(labels).where(id_fold("doc_id", folds) != held_out_fold)
    model = fit(documents, training, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = model.codes()
        for batch in batches:
            score, offending = [], []
            for text in batch.column(2).to_pylist():
                found = []
                if model.certain is not None:
                    score.append(model.certain)
                else:
                    p = model.sentences(text, codes)
                    score.append(noisy_or(p))
                    at = np.flatnonzero(p >= 0.5)
                    if score[-1] >= 0.5:
                        parts = END.split(text or "")
                        at = at if len(at) else np.array([int(p.argmax())])
                        found = [(int(i), float(p[i]), parts[i]) for i in at]
                offending.append([dict(zip(("position", "score", "text"), x)) for x in found])
            value = np.array(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= 0.5).astype(np.int32)),
                 pa.array(offending, pa.list_(pa.struct([("position", pa.int32()), ("score", pa.float64()), ("text", pa.string())])))],
                ["doc_id", "held_out", "score", "predicted", "offending"])

    chosen = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(id_fold("doc_id", folds) == held_out_fold, F.lit(False)).alias("held_out"), "text")
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, "
                                  "offending array<struct<position: int, score: double, text: string>>")
