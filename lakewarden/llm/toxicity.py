"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics.

A token's score is the log-odds that a text which holds it is toxic, less those of any text, less a drift that makes
ordinary prose sink. The odds have Dirichlet priors in a chain: a word's prior is the share of its longest known
beginning, whose prior is that of a shorter one, down to the share of toxic texts. So rare and unseen forms are judged
by their stems, and a few chance occurrences move nothing.

A linear scan finds all maximal segments of a text. The best segment of a harmless text of n tokens exceeds s about
with probability 1 - exp(-K n exp(-lambda s)); lambda and K are fitted to harmless labelled texts that did not serve for
the scores. A segment is significant if fewer than ``EXPECTED`` such segments are expected in its text. A text's
statistic adds up its significant segments in units of that law, and a logistic curve, fitted to the same labelled texts,
makes it a score.

Training reads a bounded sample of the labelled rows: at most ``ROWS``. At most ``KEYS`` words and beginnings, the most
frequent ones of that sample, have counts of their own; others are judged by their beginnings.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import (
    checkpointed,
    clean_worker,
    id_crc,
    most_frequent,
    pieces,
    position,
    sampled,
    slices,
    table_of,
    text_bytes,
)

ROWS = 20_000
KEYS = 200_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
FIT_SHARE = 0.6  # of the labelled texts; the others calibrate
STEMS = (3, 4, 5, 6)  # bytes
PRIOR = 20.0  # texts
DRIFT = 1.0
EXPECTED = 0.05
EDGES = bytes(c for c in range(33, 127) if not chr(c).isalnum())
KNOWN_WORDS = 1 << 16


def token(word: bytes) -> bytes:
    """Lower case, without signs at the ends; a word of signs only stays."""
    return word.lower().strip(EDGES) or word


def chain(word: bytes) -> list[bytes]:
    """The beginnings of a token, marked by an end no token has, then the token."""
    return [word[:n] + b" " for n in STEMS if n < len(word)] + [word]


@dataclass
class Model:
    """Scores of words and beginnings (before the drift), the law of best segments, and the logistic curve."""

    scores: dict[bytes, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 1.0
    offset: float = -math.log(1 / EXPECTED)

    def __post_init__(self):
        self._seen: dict[bytes, float] = {}

    def score(self, word: bytes) -> float:
        known = self._seen.get(word)
        if known is None:
            if len(self._seen) >= KNOWN_WORDS:
                self._seen.clear()
            known = 0.0
            for key in reversed(chain(token(word))):
                if key in self.scores:
                    known = self.scores[key]
                    break
            known = self._seen[word] = known - DRIFT
        return known

    def token_scores(self, text: bytes) -> np.ndarray:
        parts = [np.array(list(map(self.score, p.split())), np.float32) for p in pieces(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def surprise(self, best: float, n: int) -> float:
        """-log of the number of segments as good that a harmless text of n tokens has on average."""
        return self.rate * best - math.log(self.k * max(n, 1))

    def statistic(self, found: list[tuple[int, int, float]], n: int) -> float:
        each = [self.surprise(s, n) for _, _, s in found]
        sure = [x for x in each if x > -math.log(EXPECTED)]
        return sum(sure) if sure else max(each, default=self.surprise(0.0, n))

    def probability(self, statistic: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, self.slope * statistic + self.offset))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), in linear time: no segment can be made better by making it
    longer or shorter, and none overlap."""
    up = scores > 0
    if not up.any():
        return []
    # Only sums of runs matter: a segment begins and ends with a run of positive scores.
    edge = np.flatnonzero(np.diff(np.r_[False, up, False].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = np.r_[0.0, np.cumsum(scores, dtype=np.float64)]
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, nearest lower one
    for start, end, low, high in zip(starts.tolist(), ends.tolist(), sums[starts].tolist(), sums[ends].tolist()):
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= low:
                at = found[at][4]
            if at < 0 or found[at][3] >= high:
                found.append((start, end, low, high, at))
                break
            start, low, before = found[at][0], found[at][2], found[at][4]
            del found[at:]
            at = before
    return [(s, e, high - low) for s, e, low, high, _ in found]


# --- training -------------------------------------------------------------------------------------------------


def key_counts(texts: DataFrame) -> DataFrame:
    """(key, toxic, all): in how many texts, of (text, label), each word and beginning occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            keys = list(every)
            out = pa.record_batch([pa.array(keys, pa.binary()), pa.array([toxic[k] for k in keys], pa.int64()),
                                   pa.array(list(every.values()), pa.int64())], ["key", "toxic", "all"])
            toxic.clear()
            every.clear()
            return out

        for batch in slices(batches):
            for text, label in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                words = set()
                for piece in pieces(text):
                    words.update(piece.split())
                keys = {k for w in {token(w) for w in words} for k in chain(w)}
                every.update(keys)
                if label:
                    toxic.update(keys)
                if len(every) > 500_000:
                    yield flush()
        yield flush()

    parts = texts.select("text", "label").mapInArrow(count, "key binary, toxic long, all long")
    return parts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("all").alias("all"))


def log_odds(counts: dict[bytes, tuple[int, int]], toxic: int, texts: int) -> dict[bytes, float]:
    """The score of every key that is not scored (nearly) as its longest known beginning."""
    base = (toxic + 0.5) / (texts + 1)
    logit = lambda p: math.log(p / (1 - p))
    share: dict[bytes, float] = {}
    kept: dict[bytes, float] = {}
    # Beginnings come before what begins with them.
    for key in sorted(counts, key=lambda k: (len(k.rstrip(b" ")), not k.endswith(b" "))):
        word = key[:-1] if key.endswith(b" ") else key
        above = next((a for a in reversed(chain(word)[:-1]) if a in share), None)
        prior = share[above] if above is not None else base
        hits, n = counts[key]
        share[key] = (hits + PRIOR * prior) / (n + PRIOR)
        inherited = next((kept[a] for a in reversed(chain(word)[:-1]) if a in kept), 0.0)
        value = logit(share[key]) - logit(base)
        if abs(value - inherited) > 0.1:
            kept[key] = value
    return kept


def fit_law(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, K) of the best segments of harmless texts of n tokens, by maximum likelihood; a text without a positive
    score says only that its best segment is not above 0."""
    n = np.maximum(n, 1).astype(float)
    hit = best > 0
    if hit.sum() < 10:
        return 1.0, 1.0 / max(float(n.mean()) if len(n) else 1.0, 1.0)
    found = (-math.inf, 1.0, 1.0)
    for rate in np.geomspace(0.05, 20, 400).tolist():
        weight = n * np.exp(-rate * best)
        k = hit.sum() / weight.sum()
        gain = hit.sum() * (math.log(rate) + math.log(k)) - rate * best[hit].sum() - k * weight.sum()
        found = max(found, (gain, rate, k))
    return found[1], float(found[2])


def fit_curve(x: np.ndarray, label: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps; the targets leave room for doubt."""
    yes, no = int(label.sum()), int(len(label) - label.sum())
    if not yes or not no:
        return 1.0, -math.log(1 / EXPECTED)
    target = np.where(label > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
    design = np.c_[np.clip(x, -50, 50), np.ones(len(x))]
    w = np.array([0.0, math.log(yes / no)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        gradient = design.T @ (target - p) - 1e-3 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-7:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def found_in(texts: DataFrame, model: Model) -> DataFrame:
    """(label, n, scores): the sums of the segments of each text, of (text, label)."""
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, label in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                scores = sent.value.token_scores(text)
                # Enough for the curve, which takes no statistic above 50: each significant segment adds 3 or more.
                best = sorted((s for _, _, s in segments(scores)), reverse=True)
                rows.append({"label": label, "n": len(scores), "scores": best[:64]})
            yield pa.RecordBatch.from_pylist(rows, FOUND)

    return texts.select("text", "label").mapInArrow(each, "label int, n long, scores array<double>")


FOUND = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("scores", pa.list_(pa.float64()))])


def train(texts: DataFrame, keys: int = KEYS) -> Model:
    """A model from (id, text, label): a NULL text is empty. Without rows every word scores the same."""
    fold = position(F.col("id"), F.lit("fold"))
    fitted, rest = texts.filter(fold < FIT_SHARE), texts.filter(fold >= FIT_SHARE)
    sizes = fitted.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = checkpointed(key_counts(fitted).filter(F.col("all") > 1))
    known = {bytes(r["key"]): (r["toxic"], r["all"]) for r in most_frequent(counts, "all", keys).collect()}
    model = Model(log_odds(known, sizes[1], sizes[0]))
    # At most ROWS rows of a few numbers.
    found = found_in(rest, model).collect()
    clean = [r for r in found if not r["label"]]
    best = np.array([max(r["scores"], default=0.0) for r in clean])
    model.rate, model.k = fit_law(best, np.array([r["n"] for r in clean]))
    x = np.array([model.statistic([(0, 0, s) for s in r["scores"]], r["n"]) for r in found])
    model.slope, model.offset = fit_curve(x, np.array([r["label"] for r in found]))
    return model


def model_of(
    docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rows: int = ROWS, **options
) -> Model:
    """Train on the labelled documents whose crc32 of the id is not ``held_out`` modulo ``folds``, at most ``rows``
    labels of them. Of several labels of one id, the highest counts. NULL ids and labels are left out."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("label"))
    known = known.filter(F.pmod(id_crc(F.col("id")), F.lit(folds)) != held_out)
    few = F.broadcast(sampled(checkpointed(known), rows, "id"))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text")).join(few, "id")
    return train(table_of(texts, "labelled-texts"), **options)


# --- scoring --------------------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold), n_segments (the
    significant ones).

    NULL and empty texts have a score too; a NULL id is held out (its crc32 is 0); other columns are not read.
    Repeated rows count each. An empty table gives an empty result.
    """
    model = model_of(docs, labels, **options)
    sent, clean = docs.sparkSession.sparkContext.broadcast(model), clean_worker()

    @F.arrow_udf("struct<score:double,n_segments:int>")
    def judge(column: pa.Array) -> pa.Array:
        clean()
        model, out, limit = sent.value, [], -math.log(EXPECTED)
        for at in range(0, len(column), 512):
            for text in text_bytes(column.slice(at, 512)):
                scores = model.token_scores(text)
                found, n = segments(scores), len(scores)
                sure = sum(model.surprise(s, n) > limit for _, _, s in found)
                out.append({"score": model.probability(model.statistic(found, n)), "n_segments": sure})
        return pa.array(out, pa.struct([("score", pa.float64()), ("n_segments", pa.int32())]))

    rows = docs.select(F.col("doc_id").alias("doc_id"), judge(F.col("text")).alias("_j"))
    return rows.select(
        "doc_id",
        (F.pmod(id_crc(F.col("doc_id")), F.lit(FOLDS)) == HELD_OUT).alias("held_out"),
        F.col("_j.score").alias("score"),
        (F.col("_j.score") >= threshold).cast("int").alias("predicted"),
        F.col("_j.n_segments").alias("n_segments"),
    )


PASSAGES = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                      ("passage", pa.string()), ("score", pa.float64()), ("expected", pa.float64())])


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, first_word (from 0), n_words, passage (its words), score, and ``expected``,
    the number of passages as good in a harmless text of that length. Texts without one give no row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                scores = model.token_scores(text)
                found = [(*f, math.exp(-model.surprise(f[2], len(scores)))) for f in segments(scores)]
                found = [f for f in found if f[3] < EXPECTED]
                words = text.split() if found else []
                rows += [
                    {"doc_id": doc, "first_word": s, "n_words": e - s,
                     "passage": b" ".join(words[s:e]).decode("utf-8", "replace"), "score": x, "expected": p}
                    for s, e, x, p in found
                ]
            yield pa.RecordBatch.from_pylist(rows, PASSAGES)

    schema = "doc_id long, first_word long, n_words long, passage string, score double, expected double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, schema)
