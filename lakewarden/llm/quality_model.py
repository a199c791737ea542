"""A quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are its words, pairs of neighbouring words, the shapes of words (runs of letters, digits and
signs), pairs of shapes, and whether a word repeats the one before. Each is hashed into ``2 ** bits`` weights; a
text is a sparse vector of counts, scaled to a fixed length, and its score is the logistic function of the dot
product. Labels, language, source and id are no features.

Training reads a bounded sample of the labelled rows: at most ``ROWS``, those with the smallest hash of their id.
Trainers work on parts of the sample side by side, and their weights are averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.common import checkpointed, clean_worker, id_crc, pieces, sampled, text_bytes

ROWS = 20_000
BITS = 18
THRESHOLD = 0.3
LENGTH = 4.0
FOLDS, HELD_OUT = 5, 0
SHAPES = bytes(
    48 if 48 <= c < 58 else 65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c > 127 else c for c in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.S)
KNOWN_WORDS = 1 << 16


class _Words(dict):
    """word -> its hash and that of its shape; emptied when it holds many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        shape = RUNS.sub(rb"\1\1", word.translate(SHAPES))
        value = self[word] = zlib.crc32(word.lower()) << 32 | zlib.crc32(shape)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """One index per n-gram, repeats included. An empty text has the index of "no words"."""
    look, out, last = _words.__getitem__, [], None
    for piece in pieces(text):
        both = np.array(list(map(look, piece.split())), np.uint64)
        if last is not None:
            both = np.r_[last, both]
        word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        kinds = [word, shape + np.uint64(2 << 40)]
        if last is not None:  # the first word was counted with the piece before
            kinds = [k[1:] for k in kinds]
        if len(both) > 1:
            again = np.flatnonzero(word[1:] == word[:-1])
            kinds += [
                _mix(word[:-1]) + word[1:] + np.uint64(1 << 40),
                _mix(shape[:-1]) + shape[1:] + np.uint64(3 << 40),
                np.full(len(again), 4 << 40, np.uint64),
            ]
        if len(both):
            last = both[-1:]
        out += kinds
    codes = np.concatenate(out)
    if not len(codes):
        codes = np.array([5 << 40], np.uint64)
    return (_mix(codes) >> np.uint64(64 - bits)).astype(np.int64)


def vector(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The sparse vector: distinct indices, and damped counts scaled to the length LENGTH."""
    index, count = np.unique(features(text, bits), return_counts=True)
    value = np.sqrt(count)
    return index, value * (LENGTH / np.sqrt(value @ value))


class Leader:
    """Follow the regularised leader: per-coordinate steps, L1 and L2 penalties."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        gradient = (logistic(w @ value) - label) * value
        n = self.n[index]
        sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha
        self.z[index] += gradient - sigma * w
        self.n[index] = n + gradient**2


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(texts: list[bytes], labels: list[int], bits: int = BITS, rounds: int = 3, seed: int = 11) -> np.ndarray:
    """Weights of one trainer."""
    model, rng = Leader(bits), np.random.default_rng(seed)
    seen = [vector(t, bits) for t in texts]
    for _ in range(rounds):
        for i in rng.permutation(len(seen)).tolist():
            model.learn(*seen[i], labels[i])
    return model.weights(slice(None)).astype(np.float32)


def train(sample: DataFrame, bits: int = BITS, rounds: int = 3, trainers: int = 4) -> np.ndarray:
    """The averaged weights, from (text, label, at): a NULL text is empty, ``at`` deals the rows to trainers.
    Without rows all weights are zero."""
    dealt = sample.repartition(trainers, F.pmod(F.col("at"), F.lit(trainers)))

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += text_bytes(batch.column(0))
            labels += batch.column(1).to_pylist()
        if texts:
            # In an order of their own, whichever way they arrived: reruns give the same weights.
            texts, labels = zip(*sorted(zip(texts, labels)))
            weights = fit(list(texts), list(labels), bits, rounds)
            yield pa.record_batch(
                [pa.array([len(texts)], pa.int64()), pa.array([weights.tobytes()], pa.binary())], ["n", "weights"]
            )

    parts = dealt.select("text", F.col("label").cast("int").alias("label")).mapInArrow(teach, "n long, weights binary")
    total, weights = 0, np.zeros(1 << bits)
    for n, part in parts.collect():  # at most ``trainers`` rows
        weights += n * np.frombuffer(part, np.float32)
        total += n
    return (weights / max(total, 1)).astype(np.float32)


def score(text: bytes, weights: np.ndarray, bits: int = BITS) -> float:
    index, value = vector(text, bits)
    return float(logistic(weights[index].astype(np.float64) @ value))


def score_column(text: Column, df: DataFrame, weights: np.ndarray, bits: int = BITS) -> Column:
    sent, clean = df.sparkSession.sparkContext.broadcast(weights), clean_worker()

    def scores(column: pa.Array) -> pa.Array:
        clean()
        parts = (text_bytes(column.slice(at, 512)) for at in range(0, len(column), 512))
        return pa.array([score(t, sent.value, bits) for part in parts for t in part], pa.float64())

    return F.arrow_udf(scores, T.DoubleType())(text)


def model_of(
    docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rows: int = ROWS, **options
) -> np.ndarray:
    """Train on the labelled documents whose crc32 of the id is not ``held_out`` modulo ``folds``, at most
    ``rows`` labels of them. Of several labels of one id, the lowest counts. NULL ids and labels are left out."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("label"))
    known = known.filter(F.pmod(id_crc(F.col("id")), F.lit(folds)) != held_out)
    # At most ``rows`` labels are sent to the documents.
    few = F.broadcast(sampled(checkpointed(known), rows, "id"))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text")).join(few, "id")
    return train(texts.select("text", "label", F.xxhash64("id").alias("at")), **options)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    NULL and empty texts have a score too; a NULL id is held out (its crc32 is 0); other columns are not read.
    """
    weights = model_of(docs, labels, **options)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("_text"))
    rows = rows.withColumn("score", score_column(F.col("_text"), docs, weights))
    return rows.select(
        "doc_id",
        (F.pmod(id_crc(F.col("doc_id")), F.lit(FOLDS)) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they are."""
    columns = docs.columns
    weights = model_of(docs, labels, **options)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    body = F.col(f"c{columns.index('text')}")
    return renamed.filter(score_column(body, docs, weights) >= threshold).toDF(*columns)
