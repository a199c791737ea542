"""Benchmark passages in documents: random-walk embeddings, bit sampling, and exact edit verification.

An item of n words leaks into a document if some run of the document's words is within
``k = min(floor(share * n), (n - 3) // 3)`` word edits (insertions, deletions, substitutions) of it. Words are
compared in lower case (A-Z) and without ASCII punctuation.

* **Windows.** Every word starts a window of the size of each item length. A run within k edits of an item keeps
  at least ``n - 2 - 3k`` of the item's n - 2 word triples; windows with fewer benchmark triples cannot match
  and are not embedded. This loses nothing, and the count is a running sum over the document.
* **Embedding.** A random walk copies the current word to the output and moves on, or stays, by a random bit
  that depends on step and word. Texts at a small edit distance fall into step again, so their outputs have
  a small Hamming distance.
* **Bit sampling.** Each repetition takes ``width`` positions of a walk's output as a key; a window and an item meet
  if any key is equal. How many repetitions an item length needs follows from how far outputs agree after the most
  edits that it allows (``plan``): as many as reach the target recall even then. Only pairs that met are candidates.
  A length for which ``MOST`` repetitions a walk do not suffice (a few words, or thousands) is searched exactly: all its
  windows that hold enough triples are candidates.
* **Verification.** Candidates are verified by banded edit distance with a free end. For each document and item the
  best run is reported; of several, the first: around an item that was found, the windows that could hold a better
  run (the fewer edits the found one has, the more triples that takes) are verified too.

Documents are read once and not shuffled. The benchmark is a query set: it is sent to the tasks in blocks of
at most ``block_bytes`` of text, one scan of the documents per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.common import clean_worker, pieces, slices, text_bytes

PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
HITS = "doc_id long, item_id long, first_word int, last_word int, edits int, item_words int"
BITS = 18
SLOTS = 4096
VERIFIED_AT_ONCE = 4096
SHARE, TARGET, WALKS, SEED = 0.2, 0.999, 4, 7
WIDTHS, MOST, TRIALS = (3, 2, 1), 64, 256
WORDS_AT_ONCE = 1 << 18


def tokens(text: bytes) -> list[bytes]:
    return text.lower().translate(None, PUNCTUATION).split()


def allowed(n: int, share: float) -> int:
    return max(0, min(math.floor(share * n + 1e-9), (n - 3) // 3))


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random 64-bit number for each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def walk(symbols: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The embedding of the words from each start on, one row per row of ``moves``: in each step the walk
    moves on if the bit for this step and word is 1. ``symbols`` ends in a zero."""
    at, end, slots = starts.copy(), len(symbols) - 1, moves.shape[1] - 1
    out = np.empty((len(moves), len(starts)), np.int64)
    for step, move in enumerate(moves):
        out[step] = symbols.take(at, mode="clip")
        at += move.take(out[step] & slots)
    return out


@lru_cache(4096)
def plan(n: int, k: int, target: float, walks: int, seed: int) -> tuple[int, int] | None:
    """(width, samples a walk) with which a run at k edits from an item of n words meets it with the target
    probability; None if that takes more than MOST samples.

    Measured on made-up items: TRIALS of them get k random edits, and each walk's output is compared with that of the
    unchanged item. If a share a of the positions agrees, a sample of w positions does with probability a ** w.
    """
    rng = np.random.default_rng([seed, n, k])
    moves = rng.integers(0, 2, (walks, 2 * n, SLOTS), np.int8)
    plain, edited = [], []
    for _ in range(TRIALS):
        item = rng.integers(1, 1 << 20, n).tolist()
        run = list(item)
        for at, kind in zip(sorted(rng.choice(n, k, replace=False).tolist(), reverse=True), rng.integers(0, 3, k).tolist()):
            # A substitution, a deletion or an insertion.
            run[at : at + (kind < 2)] = [] if kind == 1 else [int(rng.integers(1 << 20, 1 << 21))]
        plain.append(np.r_[item, np.zeros(2 * n, np.int64)])
        edited.append(np.r_[run, np.zeros(2 * n, np.int64)])
    outs = []
    for texts in (plain, edited):
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        outs.append([walk(np.r_[np.concatenate(texts), 0], starts, m[: reach(n)]) for m in moves])
    agree = np.stack([(a == b).mean(axis=0) for a, b in zip(*outs)])  # walks x trials
    for width in WIDTHS:
        miss, samples = (1 - agree**width).clip(1e-300), 1
        while samples <= MOST:
            if 1 - np.prod(miss**samples, axis=0).mean() >= target:
                return width, samples
            samples += 1
    return None


def reach(n: int) -> int:
    """The steps of a walk over a window of n words; the last ones are most often behind it."""
    return max(1, 2 * n - n // 4)


class Matcher:
    """The index of a block of items, and the search in documents."""

    def __init__(
        self, items: list[tuple[int, bytes]], share: float, walks: int, seed: int, plans: dict[int, tuple[int, int] | None]
    ):
        self.ids, words = [i for i, _ in items], [tokens(t) for _, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for w in words:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.items = [np.array([self.vocabulary[x] for x in w], np.int64) for w in words]
        self.edits = [allowed(len(w), share) for w in words]
        lengths = sorted({len(w) for w in words if w})
        rng = np.random.default_rng(seed)
        # A random bit for each walk, step and slot of words; two steps per word on average.
        self.moves = rng.integers(0, 2, (walks, 2 * max(lengths, default=1), SLOTS), np.int8)
        # Per item length and walk: samples x width positions in the walk's output. Others are searched exactly.
        self.picks = {n: rng.integers(0, reach(n), (walks, plans[n][1], plans[n][0])) for n in lengths if plans[n]}
        self.index = {n: self._index([i for i, w in enumerate(words) if len(w) == n], n) for n in self.picks}
        self._postings()

    def _postings(self) -> None:
        """Which items have a triple (of those with fewer than three words: a first word)."""
        self.v = len(self.vocabulary) + 1
        codes, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, x in enumerate(self.items):
            if len(x) >= 3:
                codes.append(np.unique(self._codes(x)))
                owners.append(np.full(len(codes[-1]), i))
        codes, owners = np.concatenate(codes), np.concatenate(owners)
        order = np.lexsort((owners, codes))
        self.triples, at = np.unique(codes[order], return_index=True)
        self.bounds, self.owners = np.r_[at, len(codes)], owners[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[self._slot(self.triples)] = True
        self.short = {i: int(x[0]) for i, x in enumerate(self.items) if 0 < len(x) < 3}
        # The least number of an item's triples in a run that matches it.
        self.least = np.array([max(1, len(x) - 2 - 3 * k) for x, k in zip(self.items, self.edits)], np.int64)
        self.overlap = max((len(x) + k for x, k in zip(self.items, self.edits)), default=0) + 3

    def _codes(self, x: np.ndarray) -> np.ndarray:
        return (x[:-2] * self.v + x[1:-1]) * self.v + x[2:]

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (_mix(codes.astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)

    def _keys(self, symbols: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """starts x (walks * samples) keys of the windows of n words."""
        keys = []
        for w, picks in enumerate(self.picks[n]):
            out = walk(symbols, starts, self.moves[w, : int(picks.max()) + 1])
            for s in range(len(picks)):
                key = np.full(len(starts), w * MOST + s + 1, np.uint64)
                for at in picks[s]:
                    key = _mix(key + out[at].astype(np.uint64))
                keys.append(key)
        return np.stack(keys, axis=1)

    def _index(self, owners: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, their items)."""
        ends = [np.r_[self.items[i], np.zeros(2 * n, np.int64)] for i in owners]
        starts = np.cumsum([0, *[len(x) for x in ends]])[:-1]
        keys = self._keys(np.concatenate(ends), starts, n)
        owner = np.repeat(np.array(owners), keys.shape[1])
        order = np.argsort(keys.ravel(), kind="stable")
        return keys.ravel()[order], owner[order]

    def numbers(self, text: bytes) -> np.ndarray:
        get = self.vocabulary.get
        parts = [np.array([get(w, 0) for w in tokens(piece)], np.int64) for piece in pieces(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def anchors(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers of the benchmark triples that start there)."""
        if len(x) < 3 or not len(self.triples):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = x > 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:])
        codes = (x[at] * self.v + x[at + 1]) * self.v + x[at + 2]
        maybe = np.flatnonzero(self.seen[self._slot(codes)])
        found = np.minimum(np.searchsorted(self.triples, codes[maybe]), len(self.triples) - 1)
        right = self.triples[found] == codes[maybe]
        return at[maybe[right]], found[right]

    def held(self, x: np.ndarray, places: np.ndarray, triples: np.ndarray) -> dict[int, np.ndarray]:
        """Per item with enough triples in the text, their places (of one with fewer than three words: of its first)."""
        sizes = self.bounds[triples + 1] - self.bounds[triples]
        owner = self.owners[np.repeat(self.bounds[triples], sizes) + _within(sizes)]
        place = np.repeat(places, sizes)
        enough = np.flatnonzero(np.bincount(owner, minlength=len(self.items)) >= self.least)
        found = {i: place[owner == i] for i in enough[np.isin(enough, owner)].tolist()}
        return found | {i: np.flatnonzero(x == first) for i, first in self.short.items()}

    def runs(self, item: int, at: np.ndarray, k: int) -> np.ndarray:
        """The starts of the windows that hold as many of the places as a run within k edits of the item."""
        if item in self.short:
            return at
        n = len(self.items[item])
        reach, need = n + k - 3, max(1, n - 2 - 3 * k)
        # The windows with the (j)th to (j + need)th place: from the last less the reach, to the first.
        low, high = np.maximum(0, at[need - 1 :] - reach), at[: max(0, len(at) - need + 1)]
        some = low <= high
        if not some.any():
            return np.zeros(0, np.int64)
        # Overlapping ranges are counted at their ends, not written out.
        first, last = int(low[some].min()), int(high[some].max())
        edge = np.zeros(last - first + 2, np.int32)
        np.add.at(edge, low[some] - first, 1)
        np.add.at(edge, high[some] - first + 1, -1)
        return first + np.flatnonzero(np.cumsum(edge[:-1]) > 0)

    def met(self, symbols: np.ndarray, starts: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, starts of the windows that share a key with it)."""
        keys, owners = self.index[n]
        for at in range(0, len(starts), 1 << 13):
            part = starts[at : at + (1 << 13)]
            own = self._keys(symbols, part, n)
            low, high = np.searchsorted(keys, own.ravel()), np.searchsorted(keys, own.ravel(), side="right")
            hit = np.flatnonzero(high > low)
            sizes = (high - low)[hit]
            item = owners[np.repeat(low[hit], sizes) + _within(sizes)]
            pair = np.unique(item * len(part) + np.repeat(hit // own.shape[1], sizes))
            for i in np.unique(pair // len(part)).tolist():
                yield i, part[pair[pair // len(part) == i] % len(part)]

    def verify(self, x: np.ndarray, item: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start: the least edits between the item and a run that begins there (k + 1 if more than
        k), and the length of the shortest such run. Banded: only cells within k of the diagonal."""
        a, k = self.items[item], self.edits[item]
        band = np.arange(2 * k + 1)
        padded = np.concatenate([x, np.full(len(a) + 2 * k + 2, -1, np.int64)])
        far = k + 1
        row = np.where(band >= k, band - k, far)[None, :].repeat(len(starts), 0)  # row 0: j - 0 insertions
        for i in range(1, len(a) + 1):
            j = i + band - k  # words of the run used
            word = np.where(j >= 1, padded[starts[:, None] + np.maximum(j, 1) - 1], -1)
            best = row + (word != a[i - 1])
            best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
            best[:, j < 1] = far
            if i <= k:
                best[:, k - i] = i
            # An insertion in the run: from the left, at most k times in a row.
            best = np.minimum.accumulate(best - band, axis=1) + band
            row = np.minimum(best, far)
            if (row.min(axis=1) > k).all():
                break
        inside = starts[:, None] + len(a) + band[None, :] - k <= len(x)
        row = np.where(inside, row, far)
        pick = row.argmin(axis=1)
        return row[np.arange(len(starts)), pick], len(a) - k + pick

    def search_all(self, texts: list[bytes]) -> Iterator[list[tuple[int, int, int, int, int]]]:
        """For each text: (item id, first word, last word, edits, words of the item) of the items that leak."""
        numbers, gap = [self.numbers(t) for t in texts], np.zeros(2, np.int64)
        joined = np.concatenate([y for x in numbers for y in (x, gap)] or [gap])
        starts = np.cumsum([0, *[len(x) + 2 for x in numbers]])
        places, triples = self.anchors(joined)
        cuts = np.searchsorted(places, starts)
        few = int(self.least.min(initial=1 << 30))
        for d, x in enumerate(numbers):
            a, b = int(cuts[d]), int(cuts[d + 1])
            if b - a < few and not self.short:
                yield []
                continue
            best: dict[int, tuple[int, int, int]] = {}
            for start in range(0, max(1, len(x) - self.overlap), WORDS_AT_ONCE):
                # Every run that can match lies in one of the overlapping stretches.
                own = x[start : start + WORDS_AT_ONCE + self.overlap]
                c, e = np.searchsorted(places[a:b] - starts[d], [start, start + max(0, len(own) - 2)])
                for i, (edits, at, size) in self._search(own, places[a:b][c:e] - starts[d] - start, triples[a:b][c:e]).items():
                    best[i] = min(best.get(i, (1 << 30, 0, 0)), (edits, at + start, size))
            yield [(self.ids[i], s, s + m - 1, e, len(self.items[i])) for i, (e, s, m) in sorted(best.items())]

    def _search(self, x: np.ndarray, places: np.ndarray, triples: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Per item found in the stretch the edits, start and length of its best run."""
        best: dict[int, tuple[int, int, int]] = {}
        symbols, done = np.r_[x, 0], {}

        def verify(item: int, near: np.ndarray) -> None:
            for part in (near[at : at + VERIFIED_AT_ONCE] for at in range(0, len(near), VERIFIED_AT_ONCE)):
                edits, size = self.verify(x, item, part)
                at = int(np.lexsort((part, edits))[0])
                if edits[at] <= self.edits[item]:
                    found = (int(edits[at]), int(part[at]), int(size[at]))
                    best[item] = min(best.get(item, found), found)

        held = self.held(x, places, triples)
        starts: dict[int, list[np.ndarray]] = {}
        for item, at in held.items():
            n, may = len(self.items[item]), self.runs(item, at, self.edits[item])
            if n in self.index:
                starts.setdefault(n, []).append(may)
            else:
                verify(item, may)
        for n, several in starts.items():
            for item, near in self.met(symbols, np.unique(np.concatenate(several)), n):
                verify(item, near)
                done[item] = np.union1d(done.get(item, near), near)
        for item in [i for i in best if i in done]:
            # A better run, or an earlier one, holds as many triples.
            rest = self.runs(item, held[item], best[item][0]) if item in held else np.zeros(0, np.int64)
            verify(item, np.setdiff1d(rest, done[item], assume_unique=True))
        return best

    def search(self, text: bytes) -> list[tuple[int, int, int, int, int]]:
        return next(self.search_all([text]))


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def plans_of(words: list[list[bytes]], share: float, target: float, walks: int, seed: int) -> dict[int, tuple[int, int] | None]:
    """The plan of every item length. Items of one or two words allow no edits: any sample meets them."""
    lengths = sorted({len(w) for w in words if w})
    return {n: plan(n, k, target, walks, seed) if (k := allowed(n, share)) else (min(3, n), 1) for n in lengths}


def _setup(items: list[tuple[int, bytes]], share: float, target: float, walks: int, seed: int) -> tuple:
    """What a Matcher of a block is made from; plans are measured once, here."""
    return items, share, walks, seed, plans_of([tokens(t) for _, t in items], share, target, walks, seed)


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most about ``block_bytes`` of text. NULL or empty items match nothing."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    items = items.filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct()
        rows = [(r[0], bytes(r[1], "utf-8")) for r in part.collect()]
        yield sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    target: float = TARGET,
    walks: int = WALKS,
    seed: int = SEED,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per document and item that leaks into it: doc_id, item_id, the words it spans (counted from 0,
    last included), edits, item_words.

    ``target`` is the recall at the most edits that an item allows; a run with fewer is found more surely. Repeated rows
    are repeated in the result; NULL ids stay NULL. NULL and empty texts have no hits. Only doc_id and text are read. Empty tables give an empty result.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    out = None
    for items in blocks_of(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(_setup(items, share, target, walks, seed))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(*sent.value)
            schema = pa.schema([(n, pa.int64() if n.endswith("id") else pa.int32()) for n in HITS_NAMES])
            for batch in slices(batches):
                ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
                rows = [(i, *hit) for i, hits in zip(ids, matcher.search_all(texts)) for hit in hits]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows
                                      else [pa.array([], f.type) for f in schema], schema=schema)

        part = source.mapInArrow(search, HITS)
        out = part if out is None else out.unionByName(part)
    return out


HITS_NAMES = ["doc_id", "item_id", "first_word", "last_word", "edits", "item_words"]


def leak_column(text: Column, docs: DataFrame, benchmark: DataFrame, share: float = SHARE, target: float = TARGET,
                walks: int = WALKS, seed: int = SEED, block_bytes: int = 4 << 20) -> Column:
    """Whether any item leaks into the text."""
    spark, flag = docs.sparkSession, F.lit(False)
    for items in blocks_of(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(_setup(items, share, target, walks, seed))
        flag = flag | F.arrow_udf(_flags(sent), T.BooleanType())(text)
    return flag


def _flags(sent: Broadcast):
    built: list[Matcher] = []
    clean = clean_worker()

    def search(column: pa.Array) -> pa.Array:
        clean()
        if not built:
            built.append(Matcher(*sent.value))
        parts = (text_bytes(column.slice(at, 512)) for at in range(0, len(column), 512))
        return pa.array([bool(hits) for part in parts for hits in built[0].search_all(part)], pa.bool_())

    return search


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents into which no item leaks, with their columns as they are."""
    columns = docs.columns
    renamed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    body = F.col(f"c{columns.index('text')}")
    return renamed.filter(~leak_column(body, docs, benchmark, **options)).toDF(*columns)
