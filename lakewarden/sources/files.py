"""Files: JSON documents, delimited text, gazetteers, configurations and rule sets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.suggest import dbt_view, ge_view

DOCUMENT_SCHEMA = (
    "metadatatype STRING, businessDescription STRING, businessTitle STRING, "
    "metadataclass STRING, datatype STRING, bri STRING, name STRING, nullable BOOLEAN, "
    "primaryKeyColumn BOOLEAN, retention INT, tag ARRAY<STRING>, additional_metadata STRING"
)

# Documents written by one task: each is a file of its own, which costs far more than its row.
DOCUMENTS_PER_TASK = 1000


def write_documents(df: DataFrame, path: str) -> None:
    """Each row as one JSON document in a file of its own.

    The rows are dealt to one task per ``DOCUMENTS_PER_TASK`` (at least one per core), so that
    the files are made in parallel however few parts the input has.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-df.count() // DOCUMENTS_PER_TASK))
    rows = df.repartition(parts).select(F.to_json(F.struct("*")).alias("value"))
    rows.write.option("maxRecordsPerFile", 1).text(path)


def read_documents(
    spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(documents, broken files) of a folder or bucket with one JSON document per file.

    Both carry ``file``; a file that is no JSON object does not stop the others.
    """
    texts = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    whole = F.json_object_keys("value").isNotNull() & F.try_parse_json("value").isNotNull()
    documents = texts.filter(whole).select(F.from_json("value", schema).alias("d"), "file")
    return documents.select("d.*", "file"), texts.filter(~whole)


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ";"
) -> DataFrame:
    """Delimited text with a header; all columns are strings unless a schema is given."""
    reader = spark.read.option("sep", sep).option("header", True)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """(term, label) from two-column CSV without a header."""
    rows = spark.read.schema("term STRING, label STRING").csv(path)
    return rows.withColumn("label", F.rtrim("label"))


def write_activity_config(spark: SparkSession, fields: Mapping[str, list[str]], path: str) -> None:
    """Store {activity: [fields]} as JSON rows (activity, fields)."""
    entries = [
        F.struct(
            F.lit(a).alias("activity"),
            F.array(*[F.lit(f) for f in names]).cast("array<string>").alias("fields"),
        )
        for a, names in fields.items()
    ]
    rows = spark.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    rows.write.mode("overwrite").json(path)


def read_activity_config(spark: SparkSession, path: str) -> dict[str, list[str]]:
    rows = spark.read.schema("activity STRING, fields ARRAY<STRING>").json(path)
    return {r["activity"]: list(r["fields"] or []) for r in rows.orderBy("activity").collect()}


SIX_COLUMNS = [
    "table_name", "column_name", "dbt_rule_name", "ge_rule_name", "parameters", "description",
]


def write_rules_csv(suggestions: DataFrame, path: str) -> None:
    """The six text columns of the suggested rules as CSV with a header."""
    rows = suggestions.select(*SIX_COLUMNS)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_rule_views(suggestions: DataFrame, path: str) -> None:
    """The two vocabularies as two folders, dbt_rules and ge_rules."""
    for name, view in (("dbt_rules", dbt_view), ("ge_rules", ge_view)):
        view(suggestions).write.mode("overwrite").option("header", True).option(
            "escape", '"'
        ).csv(f"{path}/{name}")
