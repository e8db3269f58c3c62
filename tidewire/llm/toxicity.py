"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import materialise
from tidewire.llm.decontaminate import words_of

BITS = 18
#: Characters of the word beginnings that count as terms beside the words.
STEM = 4
#: Numbers of terms and of epochs from which cross-validation over the sample picks.
TERMS, EPOCHS, FOLDS = (64, 256, 1024), (60, 150), 3


class Terms:
    """Hashed terms of a text: its distinct words and their beginnings. Words are hashed once."""

    def __init__(self):
        self.seen: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found: set[int] = set()
        for word in set(words_of(text.lower())) if text else ():
            both = self.seen.get(word)
            if both is None:
                if len(self.seen) > 500_000:
                    self.seen.clear()
                stem = word.decode("utf-8", "ignore")[:STEM].encode()
                both = zlib.crc32(word) >> (32 - BITS), zlib.crc32(b"^" + stem) >> (32 - BITS)
                self.seen[word] = both
            found.update(both)
        return np.fromiter(found, np.int32, len(found))


class FactorizationMachine:
    """Logistic model: bias + sum of weights + sum over pairs of terms of the product of their factors."""

    def __init__(self, place: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.place, self.bias, self.weights, self.factors = place, bias, weights, factors

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        picked = [p[p >= 0] for p in (self.place[r] for r in rows)]
        starts = np.concatenate(([0], np.cumsum([len(p) for p in picked]))).astype(np.int64)
        return _sigmoid(_logits(np.concatenate([*picked, np.zeros(0, np.int64)]).astype(np.int64), starts, self.bias, self.weights, self.factors)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)))
    return total[starts[1:]] - total[starts[:-1]]


def _logits(terms: np.ndarray, starts: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = factors[terms]
    s = _sums(v, starts)
    pairs = 0.5 * (s**2 - _sums(v**2, starts)).sum(axis=1)
    return bias + _sums(weights[terms], starts) + pairs, s


def train(rows: list[np.ndarray], labels: np.ndarray, n_terms: int = 256, n_factors: int = 8, epochs: int = 60, rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Fit to (hashed terms, label) rows: the n_terms terms that tell the labels apart best, by Adam over all rows."""
    rng = np.random.default_rng(seed)
    labels = labels.astype(float)
    n, positive = len(labels), labels.sum()
    both = np.zeros((2, 1 << BITS))
    for row, y in zip(rows, labels, strict=True):
        both[int(y), row] += 1
    rate_of = both / np.maximum([[n - positive], [positive]], 1)
    spread = np.sqrt(np.maximum(both.sum(axis=0) / max(n, 1), 1 / max(n, 1)))
    gain = np.where(both.sum(axis=0) >= 3, np.abs(rate_of[1] - rate_of[0]) / spread, 0)
    kept = np.sort(np.argsort(-gain, kind="stable")[:n_terms])
    kept = kept[gain[kept] > 0]
    place = np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    prior = (positive + 0.5) / (n + 1)
    bias = np.array([np.log(prior / (1 - prior))])
    weights, factors = np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), n_factors))
    if n and 0 < positive < n and len(kept):
        picked = [p[p >= 0] for p in (place[r] for r in rows)]
        starts = np.concatenate(([0], np.cumsum([len(p) for p in picked]))).astype(np.int64)
        terms = np.concatenate(picked).astype(np.int64)
        row_of = np.repeat(np.arange(n), np.diff(starts))
        params = [bias, weights, factors]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for t in range(1, epochs + 1):
            logit, s = _logits(terms, starts, bias[0], weights, factors)
            slope = (_sigmoid(logit) - labels) / n
            g_w = np.bincount(terms, slope[row_of], len(kept)) + decay * weights
            pull = slope[row_of, None] * (s[row_of] - factors[terms])
            g_v = np.stack([np.bincount(terms, pull[:, f], len(kept)) for f in range(n_factors)], axis=1) + decay * factors
            for p, g, (m, v) in zip(params, (slope.sum(keepdims=True), g_w, g_v), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g**2 - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return FactorizationMachine(place, float(bias[0]), weights, factors)


def choose(rows: list[np.ndarray], labels: np.ndarray) -> dict[str, int]:
    """The n_terms and epochs of least log loss on folds left out in turn; none, so those of `train`, where a fold lacks a label.

    Few labelled rows carry few terms: more of them are learned by heart.
    """
    fold = np.arange(len(rows)) % FOLDS
    for side in (0, 1):  # each label is dealt out evenly
        fold[labels == side] = np.arange((labels == side).sum()) % FOLDS
    if min((labels == 0).sum(), (labels == 1).sum()) < FOLDS:
        return {}
    loss = {}
    for n_terms in TERMS:
        for epochs in EPOCHS:
            total = 0.0
            for out in range(FOLDS):
                model = train([rows[k] for k in np.flatnonzero(fold != out)], labels[fold != out], n_terms=n_terms, epochs=epochs)
                p = np.clip(model.scores([rows[k] for k in np.flatnonzero(fold == out)]), 1e-3, 1 - 1e-3)
                total -= np.where(labels[fold == out] == 1, np.log(p), np.log(1 - p)).sum()
            loss[n_terms, epochs] = total
    n_terms, epochs = min(loss, key=loss.get)
    return {"n_terms": n_terms, "epochs": epochs}


def fit(documents: DataFrame, labels: DataFrame, max_documents: int = 20_000) -> FactorizationMachine:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic).

    At most `max_documents` labelled rows are used, those of least hash; so many ids are
    broadcast to the documents, and so many rows come to the driver, each of the most telling
    terms alone, TERMS at most, whatever its text's length. Rows with a null id, text or label teach nothing. How many terms and epochs the model has is chosen by
    cross-validation over these rows. Without labels of both kinds the score is their smoothed
    share.
    """
    sample = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_documents)
    rows = documents.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")

    def hashed(batches):
        terms = Terms()
        for batch in batches:
            picked = [terms(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(picked, pa.list_(pa.int32()))], names=["doc_id", "toxic", "terms"])

    of_rows = rows.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), "text").mapInArrow(hashed, "doc_id long, toxic int, terms array<int>")
    of_rows = materialise(of_rows.withColumn("toxic", (F.col("toxic") == 1).cast("int")), "terms")
    best = F.array(*(F.lit(t) for t in best_terms(of_rows, max(TERMS)))).cast("array<int>")
    found = of_rows.select("doc_id", "toxic", F.array_intersect("terms", best).alias("terms")).collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["toxic"], r["terms"]))
    terms, toxic = [np.array(r["terms"], np.int32) for r in found], np.array([r["toxic"] for r in found], np.int64)
    return train(terms, toxic, **choose(terms, toxic))


def best_terms(rows: DataFrame, n_terms: int) -> list[int]:
    """Of rows (toxic, terms), the n_terms terms of three rows or more that tell the labels apart best; of equal ones the least."""
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("positive")).where("n >= 3")
    gain = F.abs(F.col("positive") / max(positive, 1) - (F.col("n") - F.col("positive")) / max(n - positive, 1)) / F.sqrt(F.col("n") / max(n, 1))
    return [r["term"] for r in counts.where(gain > 0).orderBy(F.desc(gain), "term").limit(n_terms).select("term").collect()]


_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(documents: DataFrame, model: FactorizationMachine) -> DataFrame:
    """(doc_id, score) for each row of documents (doc_id, text): the chance of label 1, from the whole text.

    Null and empty texts have no terms and get the score of the bias. Repeated rows are scored
    each for itself; other columns are left alone.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        terms = Terms()
        for batch in batches:
            rows = [terms(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(rows), pa.float64())], schema=_OUT)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(apply, "doc_id long, score double")
