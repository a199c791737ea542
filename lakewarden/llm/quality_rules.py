"""Quality rules: statistics of every text, fixed limits, and robust multivariate outliers.

Everything is DataFrame functions: there is no Python in the tasks.

* **Statistics** come from one pass over a text. Whether an 8-word window occurs twice is first asked of the set
  of window hashes; only texts where it does are searched for the words such windows cover.
* **Outliers.** The statistics are transformed to five coordinates (length, mean length of a word, and damped
  shares of symbols, of repeats and of capitals). Location and scatter are minimum-covariance-determinant
  estimates per language and source: starting from medians, each concentration step takes the share ``KEPT`` of
  rows with the smallest Mahalanobis distance and estimates anew from them. A text whose distance exceeds
  ``LIMIT`` is rejected. Groups of fewer than ``LEAST`` rows use the estimate of their whole language, or of all rows.
* **Scale.** A step is two aggregates with partial sums over the small table of coordinates; hot groups are
  summed before they are moved. Medians and quantiles are exact ones of rounded values, so that their memory is
  bounded and reruns agree. Rows meet the estimates of their group by a broadcast while those are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import checkpointed, table_of

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS, MAX_REPEATS = 20, 30  # words; percent of the words
P = 5
KEPT, LEAST, STEPS = 0.75, 50, 3
LIMIT = 22.11  # of the squared distance; at P = 5 normal data exceed it once in 2,000
CHI2_MEDIAN = 4.3515  # the median of a chi-squared variable with 5 degrees of freedom
# The least standard deviation of a coordinate: most texts have no symbols and no repeats at all, and a text
# is not bad for being long or short.
FLOORS = (0.90, 0.12, 0.25, 0.30, 0.12)
X = [f"x{i}" for i in range(P)]
FEW_GROUPS = 100_000


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where inner functions use it many times."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """The number of words in windows whose hash occurs twice or more."""

    def places(s: Column) -> Column:
        same = lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        marked = F.transform(s, lambda x, j: F.when(F.coalesce(same(x, j), F.lit(False)), x["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def words(p: Column) -> Column:
        steps = F.transform(p, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - i, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return bind(bind(F.array_sort(numbered), places), words)


def repeat_words(hashes: Column) -> Column:
    """From the hashes of a text's words: how many words lie in windows that are found twice or more."""
    starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    found = bind(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w)),
    )
    return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(found)


def statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper of a text; NULL is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    of_words = bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            bind(F.transform(w, lambda x: F.xxhash64(x)), repeat_words).alias("n_repeat_words"),
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = bind(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return {
        "_w": of_words,
        "_l": of_lines,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
    }


def coordinates() -> list[Column]:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    repeats = F.greatest(share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines"))
    return [
        F.log1p(F.col("n_words")),
        F.log(F.greatest(share("word_chars", "n_words"), F.lit(0.5))),
        F.log1p(20 * share("n_symbols", "word_chars")),
        F.log1p(5 * repeats),
        F.log1p(5 * share("n_upper", "word_chars")),
    ]


def _rounded(x: Column, steps: int = 64) -> Column:
    return F.round(x * steps) / steps


def _entry(i: int, j: int) -> str:
    return f"s{max(i, j)}{min(i, j)}"


def _factor(estimates: DataFrame) -> DataFrame:
    """Add the lower triangle ``l`` of the Cholesky factor of the scatter ``s``."""
    for j in range(P):
        inner = F.col(_entry(j, j)) - sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(F.greatest(inner, F.lit(FLOORS[j] ** 2 / 4))))
        for i in range(j + 1, P):
            inner = F.col(_entry(i, j)) - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            estimates = estimates.withColumn(f"l{i}{j}", inner / F.col(f"l{j}{j}"))
    keep = [f"l{i}{j}" for i in range(P) for j in range(i + 1)]
    return checkpointed(estimates.select("cell", *[f"m{i}" for i in range(P)], *keep))


def _squared_distance() -> Column:
    z: list[Column] = []
    for i in range(P):
        inner = F.col(X[i]) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * z[k] for k in range(i)), F.lit(0.0))
        z.append(inner / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _meet(rows: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    return rows.join(F.broadcast(groups) if few else groups, "cell", "left")


def _start(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Medians, and scatter from the median absolute deviations."""
    few = rows.select("cell").distinct().count() <= FEW_GROUPS
    median = rows.groupBy("cell").agg(*[F.percentile(_rounded(F.col(x)), 0.5).alias(f"m{i}") for i, x in enumerate(X)])
    median = checkpointed(median)
    off = _meet(rows, median, few)
    scales = off.groupBy("cell").agg(
        *[F.percentile(_rounded(F.abs(F.col(x) - F.col(f"m{i}"))), 0.5).alias(f"d{i}") for i, x in enumerate(X)]
    )
    both = median.join(scales, "cell")
    for i in range(P):
        for j in range(i + 1):
            value = F.greatest((F.col(f"d{i}") * 1.4826) ** 2, F.lit(FLOORS[i] ** 2)) if i == j else F.lit(0.0)
            both = both.withColumn(_entry(i, j), value)
    return _factor(both), few


def _quantile(rows: DataFrame, share: float) -> DataFrame:
    """Per cell, the quantile of the squared distance ``d2``, to about one part in 32."""
    level = F.percentile(_rounded(F.log1p(F.col("d2")), 32), share)
    return rows.groupBy("cell").agg((F.expm1(level)).alias("cut"))


def estimate(rows: DataFrame, steps: int = STEPS) -> tuple[DataFrame, bool]:
    """Per ``cell`` of (cell, x0..): location m, factor l of the scatter, and ``scale``, which makes the median
    squared distance that of normal data."""
    found, few = _start(rows)
    for _ in range(steps):
        at = _meet(rows, found, few).withColumn("d2", _squared_distance()).select("cell", *X, "d2")
        half = _meet(at, checkpointed(_quantile(at, KEPT)), few).filter(F.log1p(F.col("d2")) <= F.log1p("cut") + 1 / 64)
        sums = half.groupBy("cell").agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(X)],
            *[F.covar_pop(X[i], X[j]).alias(_entry(i, j)) for i in range(P) for j in range(i + 1)],
        )
        for i in range(P):
            sums = sums.withColumn(_entry(i, i), F.greatest(_entry(i, i), F.lit(FLOORS[i] ** 2)))
        found = _factor(sums)
    at = _meet(rows, found, few).withColumn("d2", _squared_distance())
    scale = _quantile(at, 0.5).select("cell", F.greatest(F.col("cut") / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    return checkpointed(found.join(scale, "cell")), few


def _cells(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with ``cell``, rows to estimate from).

    ``cell`` is language and source, or language, or all, whichever has enough rows that passed. The estimate of a
    language is made from all its rows that passed, that of all from all of them: a row is given once for its own
    cell and once for each wider one that some rare source needs.
    """
    counts = rows.filter("NOT base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    name = lambda *c: F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), x), F.lit("?")) for x in c])
    counts = counts.select(name(F.col("lang"), F.col("source")).alias("_own"), name(F.col("lang")).alias("_lang"), "n")
    langs = counts.groupBy("_lang").agg(F.sum("n").alias("_n"), (F.min("n") < LEAST).alias("_rare"))
    # One row per language and source; languages are few beside them.
    groups = counts.join(langs, "_lang")
    own, lang, every = F.col("_own"), F.col("_lang"), F.lit("all")
    enough = F.col("_n") >= LEAST
    groups = groups.select(
        "_own",
        F.when(F.col("n") >= LEAST, own).when(enough, lang).otherwise(every).alias("cell"),
        F.array_compact(F.array(F.when(F.col("n") >= LEAST, own), F.when(enough & F.col("_rare"), lang))).alias("_feeds"),
    )
    groups = checkpointed(groups)
    any_all = not groups.filter("cell = 'all'").isEmpty()
    put = F.broadcast if groups.count() <= FEW_GROUPS else (lambda x: x)
    out = rows.withColumn("_own", name(F.col("lang"), F.col("source"))).join(put(groups), "_own", "left")
    feeds = F.concat("_feeds", F.array(every)) if any_all else F.col("_feeds")
    sources = out.filter("NOT base_failed").withColumn("cell", F.explode(feeds)).drop("_own", "_feeds")
    return out.withColumn("cell", F.coalesce("cell", every)).drop("_own", "_feeds"), sources


def judge(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, kept, distance (squared, scaled; NULL where
    base_failed) and cell (the group whose estimate was used).

    A NULL or empty text fails for its words. NULL languages and sources are groups of their own. Ids are not
    used. Only doc_id, text, lang and source are read. An empty table gives an empty result.
    """
    got = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        *[c.alias(n) for n, c in statistics(F.col("text").cast("string")).items()],
    ).select("doc_id", "lang", "source", "_w.*", "_l.*", "n_symbols", "n_upper")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words"))
    got = table_of(got.withColumn("base_failed", failed), "statistics")
    rows = table_of(got.withColumns(dict(zip(X, coordinates()))), "coordinates")
    rows, sources = _cells(rows)
    estimates, few = estimate(table_of(sources.select("cell", *X), "samples"))
    judged = _meet(rows, estimates, few).withColumn("distance", _squared_distance() / F.col("scale"))
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))).alias("kept"),
        distance.alias("distance"),
        "cell",
    )
