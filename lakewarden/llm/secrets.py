"""Secret scans: a pattern finds candidates, a random forest removes the false positives.

DataFrame functions and Spark's own random forest only: there is no Python in the tasks.

* **Candidates** are the whole values that are assigned to a credential word, of any signs and four or more characters;
  runs of 16 or more letters, digits and ``+ / _ . -`` that hold a digit, and of 32 or more that hold a letter; and the
  headers of private keys. The pattern starts at the beginning of a run and does not go back, so its time is linear.
* **Features**: length; transitions between classes of characters and the share of each class; how much of the
  candidate's letters dictionary words cover (the words that occur most often in the corpus); whether it is part of
  a path, a host or an address; credential words and signs of assignment before it, words that say "example" near it.
* **Forest**: trained on labelled findings, at most about ``ROWS`` of them (those with the smallest hash of all their
  columns and their place). Where the caller has no labels, ``label_findings`` gives them to candidates whose form or
  assignment leaves no doubt, and leaves the others to the forest. A documented form is a secret whatever the forest has
  seen of it.
* **Scale**: candidates are a small part of the text. Their places are running sums per text over the pieces
  between candidates; texts themselves are not moved.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import most_frequent, sampled, table_of

RUN = r"[A-Za-z0-9+/_.\-]"
WORDS = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer|credential"
# A credential word, at most the rest of a name, a sign of assignment; group 1 ends where the value begins.
ASSIGNED = rf"((?i:{WORDS})[A-Za-z0-9_\-]{{0,24}}+[\"']?[ \t]{{0,4}}(?:=>|:=|[=:])[ \t]{{0,4}}[\"']?)"
VALUE = r"([^\s\"'<>\x01]{3,}[^\s\"'<>\x01,;.)])"
LONG = rf"(?<!{RUN})(?=[A-Za-z+/_.\-]*+[0-9]){RUN}{{16,}}+|(?<!{RUN})(?=[0-9+/_.\-]*+[A-Za-z]){RUN}{{32,}}+"
KEY_HEADER = r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----"
CLOUD_KEY = rf"(?<!{RUN})(?:AKIA|ASIA)[0-9A-Z]{{16}}(?!{RUN})"
CANDIDATE = rf"{ASSIGNED}{VALUE}|({KEY_HEADER}|{CLOUD_KEY}|{LONG})"
MARK = "\u0001"
NEAR = 80  # characters of context on either side
ROWS = 20_000
DICTIONARY = 50_000
CREDENTIAL = rf"(?i)(?:{WORDS})"
EXAMPLE = r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|redacted)"
# Forms that providers document for their keys.
PROVIDER = r"^-----BEGIN |^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^xox[bapr]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$"
FEATURES = [
    "length",
    "transitions",
    "digits",
    "uppers",
    "lowers",
    "signs",
    "vowels",
    "distinct",
    "covered",
    "path",
    "host",
    "credential",
    "assigned",
    "quoted",
    "example",
    "form",
]


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, start_char, end_char (exclusive), candidate, before, after."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), MARK, " ")
    cut = F.split(F.regexp_replace(text, CANDIDATE, "$1" + MARK + "$2$3" + MARK), MARK)
    hits = docs.filter(F.col("text").rlike(CANDIDATE)).select(F.col("doc_id").alias("doc_id"), cut.alias("_p"))
    hits = hits.withColumn("_row", F.monotonically_increasing_id())
    # Pieces at odd places are candidates, the ones before and after them their context.
    found = F.transform(
        F.array("_p"),
        lambda p: F.transform(
            F.sequence(F.lit(1), F.size(p) - 2, F.lit(2)),
            lambda i: F.struct(
                F.get(p, i).alias("candidate"),
                F.char_length(F.get(p, i - 1)).alias("gap"),
                F.right(F.get(p, i - 1), F.lit(NEAR)).alias("before"),
                F.left(F.get(p, i + 1), F.lit(NEAR)).alias("after"),
            ),
        ),
    )[0]
    rows = hits.select("doc_id", "_row", F.posexplode(found).alias("_i", "_f")).select("doc_id", "_row", "_i", "_f.*")
    upto = Window.partitionBy("_row").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("candidate")
    end = F.sum(F.col("gap") + size).over(upto)
    return rows.select(
        "doc_id", (end - size).cast("int").alias("start_char"), end.cast("int").alias("end_char"), "candidate", "before", "after"
    )


def dictionary(docs: DataFrame, words: int = DICTIONARY) -> DataFrame:
    """The words of four letters or more that occur in the most documents, at most ``words`` of them."""
    letters = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(r"(\p{L}{4,}+)"), 1))
    counts = docs.select(F.explode(letters).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = table_of(counts.filter("n > 1"), "words")
    return most_frequent(counts, "n", words).select("word")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add the features; ``words`` is a dictionary."""
    c, size = F.col("candidate"), F.char_length("candidate").cast("double")
    numbered = found.withColumn("_id", F.xxhash64(*found.columns))
    runs = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}{4,}+)"), 1))
    parts = numbered.select("_id", F.explode(runs).alias("word")).distinct()
    known = F.broadcast(words.withColumn("_known", F.lit(1)))  # at most DICTIONARY words
    covered = parts.join(known, "word").groupBy("_id").agg(F.sum(F.char_length("word")).alias("_covered"))
    out = numbered.join(covered, "_id", "left").drop("_id")
    letters = F.greatest(_count(c, r"\p{L}"), F.lit(1.0))
    values = {
        "length": size,
        "transitions": _count(c, r"(?=[a-z][^a-z]|[A-Z][^A-Z]|[0-9][^0-9])") / size,
        "digits": _count(c, "[0-9]") / size,
        "uppers": _count(c, "[A-Z]") / size,
        "lowers": _count(c, "[a-z]") / size,
        "signs": _count(c, "[^A-Za-z0-9]") / size,
        "vowels": _count(F.lower(c), "[aeiou]") / letters,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "covered": F.least(F.coalesce("_covered", F.lit(0)) / letters, F.lit(1.0)),
        "path": (c.contains("/") | F.col("before").rlike(r"/$|://\S*$")).cast("double"),
        "host": (F.col("before").rlike(r"@$") | F.col("after").rlike(r"^@") | c.rlike(r"\.(com|net|org|html?|py|txt)$")).cast("double"),
        "credential": F.col("before").rlike(CREDENTIAL + r"[^\n]{0,28}$").cast("double"),
        "assigned": F.col("before").rlike(r"(?:[=:]|=>)\s*[\"']?$").cast("double"),
        "form": c.rlike(PROVIDER).cast("double"),
        "quoted": (F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")).cast("double"),
        "example": (F.col("before").rlike(EXAMPLE) | F.col("after").rlike(EXAMPLE) | c.rlike(EXAMPLE)).cast("double"),
    }
    return out.withColumns(values).drop("_covered")


def label_findings(found: DataFrame) -> DataFrame:
    """Add ``label``: 1 where a documented key form, or a credential word with an assignment, leaves no doubt; 0 for
    plain numbers, hosts and dictionary words without either; else NULL."""
    c = F.col("candidate")
    sure = c.rlike(PROVIDER) | ((F.col("credential") == 1) & (F.col("assigned") == 1) & (F.col("digits") >= 0.15))
    never = c.rlike(r"^[0-9.+\-/]+$") | (F.col("host") == 1) | (F.col("covered") >= 0.5)
    bare = (F.col("credential") == 0) & (F.col("assigned") == 0)
    return found.withColumn(
        "label", F.when((F.col("example") == 0) & sure, 1.0).when(never & bare & ~c.rlike(PROVIDER), 0.0)
    )


def train(labelled: DataFrame, rows: int = ROWS, trees: int = 20, depth: int = 6, seed: int = 3) -> PipelineModel | None:
    """A forest from at most ``rows`` labelled findings; None if there are not both kinds."""
    known = labelled.filter("label IS NOT NULL").select("label", *FEATURES)
    # Equal findings differ in their place, so the bound holds for them too.
    known = known.withColumn("_at", F.monotonically_increasing_id())
    sample = table_of(sampled(table_of(known, "labelled"), rows, *known.columns), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
    )
    return PipelineModel([assembler, forest.fit(assembler.transform(sample))])


def classify(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Add ``score``, the share of the forest for "secret"; without a forest 1, so that nothing is removed."""
    if model is None:
        return found.withColumn("score", F.lit(1.0))
    scored = model.transform(found).withColumn("score", vector_to_array("_probability")[1])
    return scored.drop("_features", "_probability", "_raw", "_prediction")


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, **options) -> DataFrame:
    """One row per candidate: doc_id, start_char, end_char (exclusive), candidate, score, is_secret.

    ``labelled`` holds findings with features and label; without it ``label_findings`` labels the candidates.
    NULL and empty texts have no candidates; a NULL id stays NULL; repeated rows are repeated in the result. Only
    doc_id and text are read. An empty table gives an empty result.
    """
    found = table_of(features(candidates(docs), table_of(dictionary(docs), "dictionary")), "candidates")
    model = train(label_findings(found) if labelled is None else labelled, **options)
    sure = (F.col("form") == 1) & (F.col("example") == 0)
    out = classify(found, model).withColumn("is_secret", (F.col("score") >= threshold) | sure)
    return out.select("doc_id", "start_char", "end_char", "candidate", "score", "is_secret")
