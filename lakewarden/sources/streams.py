"""Streams of change events: (value, seq)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, per_batch: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def kafka_events(
    spark: SparkSession, servers: str, topic: str = "metadata_events", per_batch: int | None = None
) -> DataFrame:
    """Events from the earliest offset on. The topic must be keyed by bri: then all events of
    an entity are in one partition and their offsets are their order."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_batch))
    return stream.load().select(
        F.col("value").cast("string").alias("value"), F.col("offset").alias("seq")
    )


def file_events(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Events from JSON lines that carry their order in ``seq``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select("value", F.get_json_object("value", "$.seq").try_cast("bigint").alias("seq"))
