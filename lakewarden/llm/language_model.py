"""A log-bilinear language model, trained by noise-contrastive estimation, and a unigram base.

Tokens are the lower-cased words of a text and one end. The model predicts the class of the next token from the
two before it, and the token from its class:

    P(token | before) = P(class | two classes before) * P(token | class, class before)

* **Classes.** The most frequent words are classes of their own; other words share a class by their last two
  bytes, so unseen words have one too. There are ``CLASSES`` in all. Inside a class a token has the share
  (c + 1) / (N + V + 1) of the class's counts, which leaves one part for all unseen words.
* **Log-bilinear part.** The prediction is the sum of a linear map per position of the embeddings of the classes
  before; its product with the embedding of each class, and a bias, give the score. Training needs no sums over
  classes: noise-contrastive estimation separates tokens from noise of the class frequencies. Scores of texts are
  normalised exactly: one matrix product for the distinct contexts of a batch.
* **Words.** Each of the most frequent ``KNOWN`` words that is no class of its own has an embedding and a bias too:
  its share is multiplied by exp(their product with the embedding of the class before), over the sum of all words of
  the class. They are estimated by noise contrast against the shares, word by word, from the counts of all (word,
  class before) pairs; the noise is summed, not drawn. Rarer and unseen words keep their share. The sums are exact.
* **Training data** are the counts of all class triples (at most ``CLASSES ** 3`` rows) and of all pairs of known
  word and class before, over all training texts. Each round goes over every triple with its whole count;
  after it the parameters of the trainers, each with its part of the triples, are averaged.
* **Counts of words** are complete. The most frequent ``KNOWN`` words are sent to all tasks; the counts of the
  others meet the texts that use them in a join of (text, word) pairs.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import id_crc, most_frequent, pieces, slices, table_of, text_bytes

END = b"\n"  # no word holds it
FOLDS, HELD_OUT = 7, 2
HEADS, CLASSES = 96, 192
KNOWN = 1 << 18
FLUSH = 200_000
DIM = 24
TRAINERS, ROUNDS, VISITS, BATCH, NOISE = 16, 4, 500_000, 2048, 48
# Words: tasks, prior weight of an embedding, steps, words held at a time.
PART = 2.0
WORD_TASKS, PRIOR, STEPS, WORDS = 32, 12.0, 12, 2048


def tokens(text: bytes) -> list[bytes]:
    return [w for piece in pieces(text) for w in piece.lower().split()]


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over all tokens, ends included; partial counts are summed before they are moved."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in itertools.chain(slices(batches), [None]):
            for text in text_bytes(batch.column(0)) if batch is not None else []:
                for piece in pieces(text):
                    seen.update(piece.lower().split())
                seen[END] += 1
            if seen and (batch is None or len(seen) > FLUSH):
                yield pa.record_batch(
                    [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"]
                )
                seen.clear()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Lexicon(dict):
    """word -> number of a known word, or -1 - class of any other word."""

    def __init__(self, words: list[bytes], counts: list[int], suffixes: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.counts = np.array(counts, np.float64)
        self.heads = [END, *[w for w in words[:HEADS] if w != END][: HEADS - 1]]
        self.suffixes = {s: len(self.heads) + i for i, s in enumerate(suffixes[: CLASSES - HEADS - 1])}
        self.rest = len(self.heads) + len(self.suffixes)
        own = {w: i for i, w in enumerate(self.heads)}
        self.classes = np.array([own[w] if w in own else self._class(w) for w in words], np.int64)

    def data(self) -> tuple:
        """What a task builds it from."""
        return list(self), self.counts.tolist(), list(self.suffixes)

    def _class(self, word: bytes) -> int:
        return self.suffixes.get(word[-2:], self.rest)

    def __missing__(self, word: bytes) -> int:
        return 0 if word == END else -1 - self._class(word)

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """(numbers, classes) of the tokens of all texts, one after the other, and the tokens by text."""
        split = [[*tokens(t), END] for t in texts]
        n = np.array(list(map(self.__getitem__, itertools.chain.from_iterable(split))), np.int64)
        classes = np.where(n >= 0, self.classes[np.maximum(n, 0)], -1 - n) if len(self.classes) else np.maximum(-1 - n, 0)
        return n, classes, split


def before(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes two and one place before each token; the end (class 0) stands before a text, and after an
    end there is no way back to the text before it."""
    one = np.r_[0, classes[:-1]]
    two = np.r_[0, one[:-1]]
    return np.where(one == 0, 0, two), one


def count_contexts(texts: DataFrame, lexicon) -> DataFrame:
    """(code, n): counts of all class triples, and from ``CLASSES ** 3`` on of all pairs of a known word that is no
    class of its own and the class before it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, lex = [], 0, Lexicon(*lexicon.value)
        for batch in itertools.chain(slices(batches), [None]):
            if batch is not None:
                n, classes, _ = lex.numbers(text_bytes(batch.column(0)))
                two, one = before(classes)
                shared = np.flatnonzero((n >= 0) & (classes >= len(lex.heads)))
                waiting.append(((two * CLASSES + one) * CLASSES + classes).astype(np.int32))
                waiting.append((CLASSES**3 + n[shared] * CLASSES + one[shared]).astype(np.int32))
                held += len(classes)
            if held and (batch is None or held > 4_000_000):
                code, n = np.unique(np.concatenate(waiting), return_counts=True)
                waiting, held = [], 0
                # In small batches: Spark holds one at a time beside its heap.
                yield from slices([pa.record_batch([pa.array(code), pa.array(n.astype(np.int64))], ["code", "n"])], 1 << 16)

    return texts.mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Model:
    """Embeddings of classes before (one map per place) and of classes to come, and biases."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.float32)
        self.size = len(values) // (3 * DIM + 1)
        k = self.size * DIM
        self.first, self.second, self.out = (self.values[i * k : (i + 1) * k].reshape(self.size, DIM) for i in range(3))
        self.bias = self.values[3 * k :]

    @classmethod
    def start(cls, frequency: np.ndarray, seed: int = 5) -> Model:
        small = np.random.default_rng(seed).normal(0, 0.1, 3 * DIM * len(frequency))
        return cls(np.r_[small, np.log(frequency)])

    def log_probabilities(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Natural logarithms, one row per context: normalised over all classes."""
        scores = (self.first[two] + self.second[one]) @ self.out.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))

    def learn(self, codes: np.ndarray, counts: np.ndarray, frequency: np.ndarray, rate: float, draws: int | None, seed: int):
        """Noise-contrastive steps, which shrink per value: on every triple with its whole count, or on as many draws
        in proportion to the counts."""
        rng = np.random.default_rng(seed)
        noise_reach, part = np.cumsum(frequency), np.log(NOISE * frequency).astype(np.float32)
        past = [np.full_like(x, 0.1) for x in (self.first, self.second, self.out, self.bias)]
        for at, weight in all_of(counts, rng) if draws is None else drawn_from(counts, draws, rng):
            size = len(at)
            word, one, two = codes[at] % CLASSES, codes[at] // CLASSES % CLASSES, codes[at] // CLASSES**2
            noise = np.searchsorted(noise_reach, rng.random(NOISE) * noise_reach[-1], side="right").clip(0, self.size - 1)
            predicted = self.first[two] + self.second[one]
            own = (predicted * self.out[word]).sum(axis=1) + self.bias[word] - part[word]
            other = predicted @ self.out[noise].T + self.bias[noise] - part[noise]
            pull = weight / (1 + np.exp(np.clip(own, -30, 30)))  # 1 - P(data)
            push = -weight[:, None] / (1 + np.exp(-np.clip(other, -30, 30)))  # -P(data), per noise word
            back = pull[:, None] * self.out[word] + push @ self.out[noise]
            gradients = [np.zeros_like(x) for x in (self.first, self.second, self.out, self.bias)]
            np.add.at(gradients[0], two, back)
            np.add.at(gradients[1], one, back)
            np.add.at(gradients[2], word, pull[:, None] * predicted)
            np.add.at(gradients[2], noise, push.T @ predicted)
            np.add.at(gradients[3], word, pull)
            np.add.at(gradients[3], noise, push.sum(axis=0))
            for x, g, h in zip((self.first, self.second, self.out, self.bias), gradients, past):
                g /= size
                h += g * g * size
                x += rate * g / np.sqrt(h) * np.sqrt(size) / 4


def drawn_from(counts: np.ndarray, draws: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, weights) of batches drawn in proportion to the counts."""
    reach = np.cumsum(counts)
    for _ in range(0, draws, BATCH):
        at = np.searchsorted(reach, rng.random(BATCH) * reach[-1], side="right").clip(0, len(counts) - 1)
        yield at, np.ones(BATCH, np.float32)


def all_of(counts: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, weights) of batches of every place, in any order: the weights of a place sum to its count, over the
    mean weight. Large counts come in several parts, so that no batch hangs on one place. A short table is gone over
    several times, for about ``VISITS`` places."""
    parts = np.ceil(counts / (PART * np.mean(counts))).astype(np.int64)
    places = np.repeat(np.arange(len(counts)), parts)
    weight = (counts / parts * (len(places) / counts.sum())).astype(np.float32)
    for _ in range(max(1, VISITS // len(places))):
        order = rng.permutation(places)
        for low in range(0, len(order), BATCH):
            at = order[low : low + BATCH]
            yield at, weight[at]


def train(
    triples: DataFrame, frequency: np.ndarray, rounds: int = ROUNDS, draws: int | None = None, trainers: int = TRAINERS
):
    """Average the parameters of trainers, each on its part of the triples, round by round. A trainer goes over all of
    its triples in each round, or over as many draws."""
    model = Model.start(frequency)
    dealt = table_of(triples.repartition(trainers, "code"), "triples")
    if dealt.isEmpty():
        return model
    for r in range(rounds):
        values, rate = model.values, 0.3 / (1 + r)

        def learn(batches: Iterator[pa.RecordBatch], values=values, rate=rate, r=r) -> Iterator[pa.RecordBatch]:
            parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
            if sum(len(c) for c, _ in parts):
                codes, counts = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(codes, kind="stable")
                own = Model(values.copy())
                own.learn(codes[order].astype(np.int64), counts[order], frequency, rate, draws, 100 * r + 1)
                weight = np.array([counts.sum()], np.float64)
                yield pa.record_batch([pa.array(weight), pa.array([own.values.tobytes()], pa.binary())], ["n", "x"])

        # At most ``trainers`` partitions of the table, each with one row of parameters.
        found = dealt.coalesce(trainers).mapInArrow(learn, "n double, x binary").collect()
        total = sum(n for n, _ in found)
        model = Model(sum(n / total * np.frombuffer(x, np.float32).astype(np.float64) for n, x in found))
    return model


def fit_words(before_word: np.ndarray, shares: np.ndarray, before_class: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The parameters of words of one class, a row each, one per column of ``contexts``.

    ``before_word`` holds how often each class stands before each word, ``before_class`` before any word of their
    class, and ``shares`` their shares of it. Noise contrast with the noise of all ``before_class`` tokens summed:
    concave per word, so each word goes up its own objective, by steps in the principal directions of its noise.
    """
    scale, turn = np.linalg.eigh(contexts.T @ (before_class[:, None] * contexts))
    turned = (contexts @ turn).astype(np.float32)
    noise = (NOISE * shares[:, None] * before_class).astype(np.float32)
    reach = shares[:, None] * np.maximum(scale, 0) + PRIOR
    wanted = before_word.astype(np.float32)

    def at(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Objective per word, and its gradient."""
        own = np.exp(np.clip(x @ turned.T, -15, 15)) / NOISE
        rest = 1 / (1 + own)
        value = (wanted * np.log(own * rest) + noise * np.log(rest)).sum(axis=1) - PRIOR / 2 * (x * x).sum(axis=1)
        return value, (wanted * rest - noise * own * rest) @ turned - PRIOR * x

    x, rate = np.zeros(reach.shape, np.float32), np.full((len(shares), 1), 0.7, np.float32)
    value, slope = at(x)
    for _ in range(STEPS):
        tried = (x + rate * slope / reach).astype(np.float32)
        value_there, slope_there = at(tried)
        better = value_there > value
        x[better], value[better], slope[better] = tried[better], value_there[better], slope_there[better]
        rate *= np.where(better, 1.2, 0.4)[:, None]
    return (x @ turn.T).astype(np.float32)


def train_words(pairs: DataFrame, kinds: np.ndarray, shares: np.ndarray, before_class: np.ndarray, contexts: np.ndarray):
    """(parameters per known word, log sums per class before and class): every word from all of its pairs.

    ``pairs`` are (word, one, n); words are dealt over the tasks by number. ``kinds`` and ``shares`` are the words'
    classes and their shares of them.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in b.columns] for b in batches]
        word, one, n = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 3
        words, at = np.unique(word, return_inverse=True)
        for k in np.unique(kinds[words]):
            members = np.flatnonzero(kinds[words] == k)
            for low in range(0, len(members), WORDS):
                some = members[low : low + WORDS]
                place = np.full(len(words), -1)
                place[some] = np.arange(len(some))
                mine = np.flatnonzero(place[at] >= 0)
                seen = np.zeros((len(some), len(contexts)))
                np.add.at(seen, (place[at[mine]], one[mine]), n[mine])
                share = shares[words[some]]
                x = fit_words(seen, share, before_class[:, k], contexts)
                more = (share[:, None] * np.expm1(x.astype(np.float64) @ contexts.T)).sum(axis=0)
                yield pa.record_batch(
                    [pa.array([int(k)]), *[pa.array([v.tobytes()]) for v in (words[some], x, more)]], ["k", "words", "x", "more"]
                )

    values = np.zeros((len(shares), contexts.shape[1]), np.float32)
    sums = np.ones((len(contexts), CLASSES))
    dealt = pairs.repartition(WORD_TASKS, "word")
    for r in dealt.mapInArrow(learn, "k long, words binary, x binary, more binary").toArrow().to_pylist():
        words = np.frombuffer(r["words"], np.int64)
        values[words] = np.frombuffer(r["x"], np.float32).reshape(len(words), -1)
        sums[:, r["k"]] += np.frombuffer(r["more"], np.float64)
    return values, np.log(sums)


def score_documents(docs: DataFrame, known: int = KNOWN, **training) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10
    probabilities of the text under the unigram base and the model).

    Learns from rows whose crc32 of the id is not 2 modulo 7 (a NULL id counts as the empty string). A NULL or
    empty text is its end alone. Repeated rows are counted and scored as often as they occur. Only doc_id and text
    are read. Without training texts the base gives every token probability 1; an empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.pmod(id_crc(F.col("doc_id")), F.lit(FOLDS)) == HELD_OUT
    texts = source.filter(~held).select("text")
    counts = table_of(count_words(texts), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    suffix = F.expr("substring(word, -2, 2)")
    top = most_frequent(counts, "c", known).toArrow()  # at most ``known`` rows
    ranked = sorted(zip(top["c"].to_pylist(), top["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
    words = [w for _, w in ranked]
    heads = [END, *[w for w in words[:HEADS] if w != END][: HEADS - 1]]
    tails = counts.filter(~F.col("word").isin([bytearray(w) for w in heads])).groupBy(suffix.alias("s"))
    ends = tails.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # at most 65,792 suffixes
    ends.sort(key=lambda r: (-r["n"], bytes(r["s"])))
    lexicon = Lexicon(words, [c for c, _ in ranked], [bytes(r["s"]) for r in ends])
    # Tokens and words of each class, for the share of a word in it.
    inside, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in ends:
        k = lexicon.suffixes.get(bytes(r["s"]), lexicon.rest)
        inside[k] += r["n"]
        kinds[k] += r["v"]
    for i, w in enumerate(lexicon.heads):
        inside[i] = lexicon.counts[lexicon[w]] if w in lexicon else 0
    frequency = (inside + 1) / (inside + 1).sum()
    sent = spark.sparkContext.broadcast(lexicon.data())
    found = table_of(count_contexts(texts, sent), "contexts")
    triples, code = found.filter(F.col("code") < CLASSES**3), F.col("code") - CLASSES**3
    model = train(triples, frequency, **training)
    values, class_size = model.values, np.log10(inside + kinds + 1)
    class_size[: len(lexicon.heads)] = 0.0
    before_class = np.zeros((CLASSES, CLASSES))  # class before, class
    pair = (F.col("code") % CLASSES**2).alias("pair")
    for r in triples.groupBy(pair).agg(F.sum("n").alias("n")).collect():  # at most CLASSES ** 2
        before_class[r["pair"] // CLASSES, r["pair"] % CLASSES] = r["n"]
    pairs = found.filter(code >= 0).select(
        F.floor(code / CLASSES).cast("long").alias("word"), (code % CLASSES).cast("long").alias("one"), "n"
    )
    contexts = np.c_[model.second, np.ones(CLASSES)].astype(np.float32)
    shares = (lexicon.counts + 1) / (inside + kinds + 1)[lexicon.classes] if words else np.zeros(0)
    of_word, log_sums = train_words(pairs, lexicon.classes, shares, before_class, contexts)
    sent_words = spark.sparkContext.broadcast(of_word)
    base_size, single = float(np.log10(total + distinct + 1)), len(lexicon.heads)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text, and a row per text and word that is not sent along."""
        lex, own, row = Lexicon(*sent.value), Model(values), TaskContext.get().partitionId() << 40
        gain, of_word = np.log10(lex.counts + 1), sent_words.value
        for batch in slices(batches):
            ids, crcs = batch.column(0), batch.column(1)
            n, classes, split = lex.numbers(text_bytes(batch.column(2)))
            two, one = before(classes)
            context, at = np.unique(two * CLASSES + one, return_inverse=True)
            chance = np.empty(len(n))
            for low in range(0, len(context), 4096):
                part = own.log_probabilities(context[low : low + 4096] // CLASSES, context[low : low + 4096] % CLASSES)
                mine = np.flatnonzero((at >= low) & (at < low + 4096))
                chance[mine] = part[at[mine] - low, classes[mine]]
            seen = n >= 0
            word = np.where(seen, gain[np.maximum(n, 0)], 0.0) if len(gain) else np.zeros(len(n))
            inner = np.where(classes < single, 0.0, word - class_size[classes] - log_sums[one, classes] / np.log(10))
            shared = np.flatnonzero(seen & (classes >= single))
            for low in range(0, len(shared), 1 << 16):
                some = shared[low : low + (1 << 16)]
                inner[some] += np.einsum("ij,ij->i", of_word[n[some]], contexts[one[some]]) / np.log(10)
            sizes = np.array([len(s) for s in split])
            starts = np.cumsum(sizes) - sizes
            base = np.add.reduceat(word - base_size, starts)
            got = np.add.reduceat(chance / np.log(10) + inner, starts)
            known_here = np.add.reduceat((seen & (len(gain) > 0)).astype(np.int64), starts)
            rows = row + np.arange(len(split))
            row += len(split)
            yield _batch(rows, ids, crcs, None, None, sizes, known_here, base, got)
            missing = np.flatnonzero(~seen)
            if len(missing):
                owner = np.searchsorted(starts, missing, side="right") - 1
                pairs = Counter((d, split[d][i - starts[d]]) for d, i in zip(owner.tolist(), missing.tolist()))
                where = rows[np.array([d for d, _ in pairs])]
                yield _batch(where, None, None, [w for _, w in pairs], list(pairs.values()), None, None, None, None)

    rows = source.select(F.col("doc_id").cast("string"), held.alias("held"), "text").mapInArrow(score, SCORED)
    rows = table_of(rows, "scores")
    rare = rows.filter("word IS NOT NULL").select("row", "word", "n").join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("more_known"),
    )
    out = rows.filter("word IS NULL").join(rare, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


SCORED = (
    "row long, doc_id string, held_out boolean, word binary, n long, n_tokens long, n_known long, base double, score double"
)


def _batch(rows, ids, held, words, n, sizes, known, base, score) -> pa.RecordBatch:
    k = len(rows)
    kinds = [pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    columns = [rows, ids, held, words, n, sizes, known, base, score]
    names = ["row", "doc_id", "held_out", "word", "n", "n_tokens", "n_known", "base", "score"]
    made = [
        pa.nulls(k, t) if c is None else c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t)
        for c, t in zip(columns, kinds)
    ]
    return pa.record_batch(made, names)
