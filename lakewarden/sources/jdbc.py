"""Databases over JDBC. The driver jar of the database must be on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakewarden.operators.catalog import UNIFIED_COLUMNS


def columns_query(source_type: str) -> str:
    """The query, run by the database itself, that lists its columns in unified form."""
    name = source_type.replace("'", "''")
    return (
        f"SELECT '{name}' AS source_type, table_catalog AS database_name, "
        "table_schema AS schema_name, table_name, column_name, data_type, is_nullable, "
        "'NO' AS is_partitioned, 'NO' AS is_view, NULL AS dependent_tables "
        "FROM information_schema.columns"
    )


def jdbc_metadata(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    source_type: str,
    partition: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns of a database as unified metadata.

    ``partition`` may hold partitionColumn, lowerBound, upperBound and numPartitions, to read
    a very large catalog in parallel.
    """
    reader = spark.read.format("jdbc").options(**properties)
    reader = reader.option("url", url).option("dbtable", f"({columns_query(source_type)}) AS metadata")
    rows = reader.options(**(partition or {})).load()
    return rows.select(*[rows[c].cast("string").alias(c) for c in UNIFIED_COLUMNS])


def write_metadata(
    unified: DataFrame, url: str, properties: Mapping[str, str], table: str = "unified_metadata"
) -> None:
    """Replace the rows of the table and keep its definition."""
    (
        unified.select(*UNIFIED_COLUMNS)
        .write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .options(**properties)
        .save()
    )
