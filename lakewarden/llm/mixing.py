"""Mix sources to target weights: exact length counts, subset sums for the budget, seeded documents.

* The documents of each source are counted by exact size (words). All that follows works on these counts: their
  number is bounded by the number of distinct sizes of a source, not by its documents.
* Weights go to the sources in the order of their names (code points, NULL last), repeating. They share the
  words of all documents; no source gets more than ``most`` times its own size, and what it cannot use is shared
  again by weight.
* A source whose target is at least its size is taken whole as often as fits. The rest of the target is a
  subset-sum problem on the counts: every size gives its share of documents (rounded down), larger sizes fill up
  while more than ``window`` words are missing, and a bounded-knapsack dynamic program finds the sum
  of remaining documents that comes nearest to what is missing.
* The documents of a size are chosen by a seeded hash of their id. Large groups are numbered in buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import checkpointed, clean_worker, numbered, pieces, position, table_of, text_bytes
from lakewarden.operators.skew import numbered as in_order

WEIGHTS = (5, 2, 1)
MOST = 3
WINDOW = 1 << 16
PLAN = "source string, size long, whole int, chosen long"


def size_column(text: Column) -> Column:
    """The number of words."""

    clean = clean_worker()

    @F.arrow_udf("long")
    def sizes(column: pa.Array) -> pa.Array:
        clean()
        out = []
        for at in range(0, len(column), 512):
            out += [sum(len(p.split()) for p in pieces(t)) for t in text_bytes(column.slice(at, 512))]
        return pa.array(out, pa.int64())

    return sizes.asNondeterministic()(text)


def _bits(x: int) -> np.ndarray:
    raw = np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def nearest_sum(sizes: Sequence[int], counts: Sequence[int], budget: int, over: bool = True) -> list[int]:
    """How many of each size to take so that the sum is as near to the budget as any can be (of two equally near
    ones, the lower); with ``over`` false, not above it.

    Bounded knapsack: counts are split into powers of two; reachable sums are bits of an integer of at most twice the
    budget. For every sum only the lot that first reached it is kept. Of sizes above the budget only the smallest one
    can be nearest, and only by itself.
    """
    lots, taken = [], [0] * len(sizes)  # (index, how many at once)
    for i, (size, count) in enumerate(zip(sizes, counts)):
        count = min(count, budget // size + over) if 0 < size <= budget else 0
        step = 1
        while count > 0:
            lots.append((i, min(step, count)))
            count -= lots[-1][1]
            step *= 2
    # A nearest sum above the budget is less than one size above it.
    width = budget + (max((sizes[i] for i, _ in lots), default=0) if over else 0) + 1
    full, reached, first = (1 << width) - 1, 1, np.zeros(width, np.int32)
    for k, (i, n) in enumerate(lots):
        new = (reached << sizes[i] * n) & full & ~reached
        if new:
            first[_bits(new)] = k
            reached |= new
        if reached >> budget & 1:
            break
    best = (reached & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reached >> (budget + 1)
    if above and (above & -above).bit_length() < budget - best:
        best = budget + (above & -above).bit_length()
    large = [(size, i) for i, (size, count) in enumerate(zip(sizes, counts)) if over and count > 0 and size > budget]
    if large and min(large)[0] - budget < abs(budget - best):
        taken[min(large)[1]] = 1
        return taken
    while best:
        i, n = lots[first[best]]
        taken[i] += n
        best -= int(sizes[i]) * n
    return taken


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each size to take so that their words come near the budget."""
    total = int(sizes @ counts)
    taken = np.zeros(len(sizes), np.int64)
    if not total or budget <= 0:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    missing = budget - int(sizes @ taken)
    order = np.argsort(-sizes, kind="stable")
    for i in order:  # larger sizes first, down to what the program below can fill exactly
        if sizes[i] and missing > window:
            more = min(int(counts[i] - taken[i]), (missing - window // 2) // int(sizes[i]))
            taken[i] += max(0, more)
            missing -= max(0, more) * int(sizes[i])
    while missing > 0:
        part = min(missing, window)
        left = [int(i) for i in order[::-1] if sizes[i] and counts[i] > taken[i]]
        own, free = [int(sizes[i]) for i in left], [int(counts[i] - taken[i]) for i in left]
        more = np.zeros(len(sizes), np.int64)
        more[left] = nearest_sum(own, free, part, over=missing <= window)
        taken += more
        missing -= int(sizes @ more)
        if not more.any():
            break
    return taken


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to (source, size): the budget is the sum of all sizes. One small aggregate per round; a
    round stops at least one more source at its bound, or ends."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_i"))
    # One row per source; very many are numbered by ranges.
    named = in_order(sources.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"], "_n")
    sources = named.withColumn("_i", ((F.col("_n") - 1) % len(weights) + 1).cast("int")).withColumn("_w", weight)
    sources = checkpointed(sources.drop("_null", "_n"))
    bound, level, capped = F.col("size") * float(most), 0.0, -1
    total = sources.agg(F.sum("size")).first()[0] or 0
    while True:
        at_bound = bound < F.col("_w") * level
        used, free, n = sources.agg(
            F.coalesce(F.sum(F.when(at_bound, bound)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_bound, F.col("_w"))), F.lit(0.0)),
            F.coalesce(F.sum(at_bound.cast("long")), F.lit(0)),
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total - used) / free
    return sources.withColumn("target", F.least(bound, F.col("_w") * level)).drop("_i", "_w")


def plan(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, window: int = WINDOW) -> DataFrame:
    """From (source, size) per document: source, size, n, source_size, target, whole (times that every
    document is taken) and chosen (how many documents of this size are taken once more)."""
    counts = checkpointed(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sums = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("size"))
    wanted = checkpointed(targets(sums, weights, most).withColumnRenamed("size", "source_size"))
    same = counts["source"].eqNullSafe(wanted["source"])
    both = counts.join(F.broadcast(wanted), same).drop(wanted["source"]) if _few(wanted) else counts.join(
        wanted, same).drop(wanted["source"])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        total, target = int(group.source_size.iloc[0]), float(group.target.iloc[0])
        whole = min(most, int(target // total)) if total else 0
        rest = 0 if whole >= most else int(round(target - whole * total))
        chosen = fit(group["size"].to_numpy(np.int64), group.n.to_numpy(np.int64), rest, window)
        return group.assign(whole=np.int32(whole), chosen=chosen)

    schema = "source string, size long, n long, source_size long, target double, whole int, chosen long"
    named = both.select(F.col("source").cast("string"), "size", "n", "source_size", "target")
    return checkpointed(named.groupBy("source").applyInPandas(choose, schema))


def _few(df: DataFrame, rows: int = 100_000) -> bool:
    return df.count() <= rows


def mix(sizes: DataFrame, seed: int = 17, **options) -> DataFrame:
    """Add source_size, target and taken (words) to rows (id, source, size); other columns are kept."""
    chosen = plan(sizes.select("source", "size"), **options)
    rows = sizes.withColumn("_at", position(F.col("id").cast("string"), F.lit(seed)))
    ranked = numbered(rows, ["source", "size"], "_at", ["id"], "_rank")
    same = [ranked["source"].eqNullSafe(chosen["source"]), ranked["size"] == chosen["size"]]
    found = ranked.join(chosen.hint("broadcast") if _few(chosen) else chosen, same, "left")
    times = F.col("whole") + (F.col("_rank") < F.col("chosen")).cast("int")
    return found.select(
        *[ranked[c] for c in sizes.columns],
        "source_size",
        "target",
        times.alias("times"),
        (ranked["size"] * times).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (words), source_size, target (of its source), taken (words the
    mix takes of it, repeats counted), times.

    A NULL or empty text has size 0 and takes nothing; rows with a NULL source are a source of their own; ids that
    are NULL or repeated are chosen in the order of their hash. Only doc_id, text and source are read. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").alias("id"), F.col("source").cast("string").alias("source"), F.col("text").alias("_t"))
    rows = table_of(rows.withColumn("size", size_column(F.col("_t"))).drop("_t"), "sizes")
    return mix(rows, **options).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "times")


def take(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them, with their columns as they are."""
    columns = docs.columns
    keyed = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    id, text, source = (F.col(f"c{columns.index(c)}") for c in ("doc_id", "text", "source"))
    # Repeated rows are told apart by their number among equal ids and texts.
    keyed = keyed.withColumns({"_k": F.xxhash64(id, source), "_t": F.xxhash64(text)})
    slim = keyed.select(id.alias("id"), source.cast("string").alias("source"), "_k", "_t", size_column(text).alias("size"))
    mixed = mix(table_of(slim, "sizes"), **options).filter("times > 0")
    # Rows that agree in id, source and text share their times.
    times = mixed.groupBy("_k", "_t").agg(F.sum("times").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    number = F.row_number().over(Window.partitionBy("_k", "_t").orderBy("_k")) - 1
    found = keyed.join(times, ["_k", "_t"]).withColumn("_i", number)
    each, over = F.floor(F.col("_n") / F.col("_rows")), F.col("_n") % F.col("_rows")
    repeats = (each + (F.col("_i") < over).cast("long")).cast("int")
    out = found.withColumn("_r", repeats).filter("_r > 0").withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("_r"))))
    return out.select(*[f"c{i}" for i in range(len(columns))]).toDF(*columns)
