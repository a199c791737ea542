"""Token counts: an exact histogram of encoded lengths, and what follows from its suffix sums.

Every document is encoded whole by a byte-level BPE vocabulary whose path is a parameter. Documents are counted by
(source, length); all totals, quantiles and truncated totals are sums over that histogram, so no context limit
needs another look at the texts.

The histogram is summed in blocks of ``BLOCK`` lengths: running sums inside a block, and running sums of the
blocks. No task holds all lengths of all documents.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import checkpointed, clean_worker

BLOCK = 512
VOCABULARY = "byte_bpe_50k.tiktoken"
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a file of lines "base64 rank"."""
    if path not in _encodings:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def length_column(text: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The number of tokens of a text; NULL is empty. Strings of special tokens are ordinary text."""
    path = path or public_tokenizers.path(VOCABULARY)

    clean = clean_worker()

    @F.arrow_udf("long")
    def lengths(column: pa.Array) -> pa.Array:
        clean()
        tokenizer = encoding(path, pattern)
        return pa.array([len(tokenizer.encode_ordinary(t.as_py() or "")) for t in column], pa.int64())

    return lengths.asNondeterministic()(text)


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(source, length, n_docs): partial counts are summed before they are moved."""
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("_text"))
    rows = rows.withColumn("length", length_column(F.col("_text"), path))
    return rows.groupBy("source", "length").agg(F.count(F.lit(1)).alias("n_docs"))


def totals(counts: DataFrame) -> DataFrame:
    """From a histogram: for every length as a context limit, per source and (scope "all", source NULL) for all.

    docs_up_to and tokens_up_to: documents that fit whole; docs_beyond: longer ones; truncated_total: tokens kept
    if every document is cut at the limit; lost: tokens cut off; quantile: the share of documents up to it.
    """
    counts = checkpointed(counts)
    own = counts.select(F.lit("source").alias("scope"), "source", "length", "n_docs")
    every = counts.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    every = every.select(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("source"), "length", "n_docs")
    rows = own.unionByName(every).withColumn("_block", F.floor(F.col("length") / BLOCK))
    rows = rows.withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    group = ["scope", "source"]
    inside = Window.partitionBy(*group, "_block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_d": F.sum("n_docs").over(inside), "_t": F.sum("n_tokens").over(inside)})
    blocks = rows.groupBy(*group, "_block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    blocks = blocks.select(
        *[F.col(c).alias(f"_g_{c}") for c in [*group, "_block"]],
        F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("_d0"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("_t0"),
        F.sum("d").over(whole).alias("_docs"),
        F.sum("t").over(whole).alias("_tokens"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in [*group, "_block"]]
    docs, tokens = F.col("_d") + F.col("_d0"), F.col("_t") + F.col("_t0")
    kept = tokens + F.col("length") * (F.col("_docs") - docs)
    return rows.join(blocks, same).select(
        *group,
        "length",
        "n_docs",
        "n_tokens",
        docs.alias("docs_up_to"),
        tokens.alias("tokens_up_to"),
        (F.col("_docs") - docs).alias("docs_beyond"),
        kept.alias("truncated_total"),
        (F.col("_tokens") - kept).alias("lost"),
        (docs / F.col("_docs")).alias("quantile"),
    )


def at_limits(counts: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(source, limit, truncated_total) for given context limits, from a histogram."""
    spread = counts.withColumn("limit", F.explode(F.array(*[F.lit(int(x)) for x in limits])))
    kept = F.col("n_docs") * F.least(F.col("length"), F.col("limit"))
    return spread.groupBy("source", "limit").agg(F.sum(kept).alias("truncated_total"))


def quantile(counts: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of all documents do not exceed; None without documents."""
    found = totals(counts).filter((F.col("scope") == "all") & (F.col("quantile") >= share))
    return found.agg(F.min("length")).first()[0]


def length_totals(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The totals of all documents. NULL and empty texts have length 0; a NULL source is a source of its own;
    repeated rows count each. Only text and source are read. An empty table gives an empty result."""
    return totals(histogram(docs, path))
