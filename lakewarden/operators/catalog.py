"""Technical metadata of catalogs in one form, one row per column."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.settings import small_frame

# Fixed values.
UNIFIED_COLUMNS = [
    "source_type",
    "database_name",
    "schema_name",
    "table_name",
    "column_name",
    "data_type",
    "is_nullable",
    "is_partitioned",
    "is_view",
    "dependent_tables",
]
UNIFIED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in UNIFIED_COLUMNS])

# After FROM or JOIN: `db`.`table`, `db.table` or db.table.
_SOURCE = r"(?i)\b(?:from|join)\s+(`[^`]+`\s*\.\s*`[^`]+`|`[^`.]+\.[^`]+`|[\w$]+\.[\w$]+)"


def dependent_tables(view_text: Column) -> Column:
    """The qualified tables that a view's text reads, joined by ", ", or NULL."""
    found = F.regexp_extract_all(view_text, F.lit(_SOURCE), F.lit(1))
    names = F.array_distinct(
        F.transform(found, lambda n: F.regexp_replace(F.replace(n, F.lit("`"), F.lit("")), r"\s*\.\s*", "."))
    )
    return F.when(F.size(names) > 0, F.array_join(names, ", "))


def view_dependencies(views: DataFrame, text_column: str = "view_text") -> DataFrame:
    """Add ``dependent_tables`` to rows that hold the text of a view."""
    return views.withColumn("dependent_tables", dependent_tables(F.col(text_column)))


def _yes(flag: bool) -> str:
    return "YES" if flag else "NO"


def catalog_metadata(
    spark: SparkSession, databases: Sequence[str] | None = None, source_type: str = "Hive"
) -> DataFrame:
    """The tables and views of the session catalog in unified form.

    This is a walk over the catalog service, as large as the catalog; no table is read. Views of
    the session belong to no database; they are listed once, without one.
    """
    rows, session = [], set()
    names = databases or [d.name for d in spark.catalog.listDatabases()]
    for database in names:
        for table in spark.catalog.listTables(database):
            temporary = table.isTemporary
            if temporary and table.name in session:
                continue
            if temporary:
                session.add(table.name)
            qualified = f"`{table.name}`" if temporary else f"`{database}`.`{table.name}`"
            is_view = temporary or table.tableType == "VIEW"
            text = None
            if is_view and not temporary:
                described = spark.sql(f"DESCRIBE EXTENDED {qualified} AS JSON").first()[0]
                text = json.loads(described).get("view_text")
            for column in spark.catalog.listColumns(qualified):
                rows.append(
                    (
                        source_type, None if temporary else database, None, table.name, column.name, column.dataType,
                        _yes(column.nullable), _yes(column.isPartition), _yes(is_view), text,
                    )
                )
    listed = small_frame(spark, rows, UNIFIED_SCHEMA)
    return view_dependencies(listed, "dependent_tables").select(*UNIFIED_COLUMNS)


def unify(*catalogs: DataFrame) -> DataFrame:
    """All rows of several catalogs, with the ten columns as strings."""
    parts = [c.select(*[F.col(n).cast("string").alias(n) for n in UNIFIED_COLUMNS]) for c in catalogs]
    return reduce(DataFrame.unionByName, parts)
