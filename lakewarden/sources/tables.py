"""Catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The columns of the workflow activity and standardisation tables.
ACTIVITY_COLUMNS = [
    "workflow_id",
    "activity",
    "activity_status",
    "activity_completion_time",
    "activity_parent",
    "activity_out",
]
STANDARD_COLUMNS = ["input_value", "standardized_value"]


def read_columns(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """A catalog table, of which only the named columns are read."""
    return spark.table(table).select(*columns)


def read_activities(spark: SparkSession, table: str) -> DataFrame:
    return read_columns(spark, table, ACTIVITY_COLUMNS)


def read_standards(spark: SparkSession, table: str) -> DataFrame:
    return read_columns(spark, table, STANDARD_COLUMNS)


def overwrite_table(df: DataFrame, table: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Replace a managed table; bucketed by a column if later joins need it."""
    writer = df.write.mode("overwrite")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a table, for example validated entities with their defaults."""
    df.write.mode("append").saveAsTable(table)
