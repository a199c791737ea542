"""Cells of a table as rows, and tables rebuilt from rows of literal text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.skew import lookup_join
from lakewarden.settings import ROWS_PER_GROUP, fresh_path, work_dir

# Keys of a table's records become its columns; more of them than this are data.
MAX_COLUMNS = 10_000


def _as_text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def unpivot_cells(
    df: DataFrame, n: int | None = None, order_by: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """(id, values): one row per non-NULL cell, ``id`` being the column's ordinal.

    With ``n``, only the first n rows in the given order. Columns in ``keep`` are carried
    along. The table is read once and not shuffled.
    """
    if n is not None:
        df = df.orderBy(*(order_by or df.columns)).limit(n)
    cells = F.array(*[_as_text(f) for f in df.schema.fields])
    return df.select(*keep, F.posexplode(cells).alias("id", "values")).filter(
        F.col("values").isNotNull()
    )


def column_dictionary(df: DataFrame) -> DataFrame:
    """(id, columnname), from the schema alone."""
    entries = [
        F.struct(F.lit(i).alias("id"), F.lit(name).alias("columnname"))
        for i, name in enumerate(df.columns)
    ]
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# Quoted strings, and the text between them.
_PIECES = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|[^'\"]++|['\"]"


# A backslash that escapes something else than a quote, a backslash, a slash, one of b f n r t, or code numbers.
UNKNOWN_ESCAPE = r"(?<!\\)(?:\\\\)*\\(?![\"'\\/bfnrt]|u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2})"


def literal_to_json(text: Column) -> Column:
    """Literal text with None, True and False outside quotes rewritten for a JSON reader."""

    def rewrite(piece: Column) -> Column:
        plain = piece
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            plain = F.regexp_replace(plain, rf"\b{word}\b", json_word)
        quoted = piece.startswith("'") | piece.startswith('"')
        # \\xNN, of which JSON readers know nothing, as \\u00NN.
        decoded = F.regexp_replace(piece, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        return F.when(quoted, decoded).otherwise(plain)

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    rewritten = F.array_join(F.transform(pieces, rewrite), "")
    return F.when(text.rlike(r"None|True|False|\\x"), rewritten).otherwise(text)


def parse_records(
    df: DataFrame, key_columns: Sequence[str], raw_column: str
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of literal rows.

    records: the input columns, ``filename`` (the key parts joined by a dot) and ``record``,
    a map of strings. Rows whose text is not one record and no more, or holds an escape that
    is not known, are quarantined; text is only parsed, never executed.
    """
    parts = [F.col(k) for k in key_columns]
    name = parts[0]
    for part in parts[1:]:
        name = F.concat(name, F.lit("."), part)
    # Read as a list of records, text behind the first one shows.
    listed = F.concat(F.lit("["), literal_to_json(F.col(raw_column)), F.lit("]"))
    records = F.from_json(
        listed, "array<map<string,string>>", {"allowBackslashEscapingAnyCharacter": "true"}
    )
    strange = F.col(raw_column).rlike(UNKNOWN_ESCAPE)
    record = F.when((F.size(records) == 1) & ~strange, F.get(records, F.lit(0)))
    parsed = df.withColumn("filename", name).withColumn("record", record)
    good = F.col("record").isNotNull() & F.col("filename").isNotNull()
    return parsed.filter(good), parsed.filter(~good).drop("record")


def record_columns(records: DataFrame) -> DataFrame:
    """(filename, columnname): the union of the keys of each table."""
    keys = F.explode(F.map_keys("record")).alias("columnname")
    return records.select("filename", keys).distinct()


def rebuild_table(records: DataFrame, filename: str, columns: Sequence[str]) -> DataFrame:
    """One table as all-string columns, NULL where a record lacks the key."""
    values = [F.element_at("record", F.lit(c)).alias(c) for c in columns]
    return records.filter(F.col("filename") == filename).select(*values)


def cell(value: Column) -> Column:
    """A text as a cell of a CSV line, quoted where that is needed; NULL is empty."""
    return F.coalesce(F.to_csv(F.struct(value.alias("v"))), F.lit(""))


def _line(cells: Column) -> Column:
    line = F.array_join(cells, ",")
    # The one cell of a line is empty: readers skip blank lines.
    return F.when(line == "", F.lit('""')).otherwise(line)


def table_columns(records: DataFrame, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """(filename, columns): the sorted union of the keys of each table. A table of more than ``max_columns`` keys is
    an error: its keys are data."""
    keys = record_columns(records).checkpoint()
    widest = keys.groupBy("filename").count().agg(F.max_by(F.struct("filename", "count"), "count")).first()[0]
    if widest is not None and widest["count"] > max_columns:
        raise ValueError(f"the records of {widest['filename']} have {widest['count']} different keys")
    return keys.groupBy("filename").agg(F.sort_array(F.collect_list("columnname")).alias("columns"))


def write_tables(
    records: DataFrame, path: str, rows_per_file: int = ROWS_PER_GROUP, max_columns: int = MAX_COLUMNS
) -> DataFrame:
    """Write all tables as CSV, each in its folder ``filename=<table>`` below ``path``, by one job whatever the number
    of tables; returns (filename, columns, n_rows).

    Every file begins with the header of its table. A table of many rows is written by several tasks.
    """
    spark = records.sparkSession
    work_dir(spark)
    staged = fresh_path(spark, "records")
    named = records.select(F.coalesce("filename", F.lit("")).alias("filename"), "record")
    named.write.parquet(staged)
    rows = spark.read.schema("filename STRING, record MAP<STRING,STRING>").parquet(staged)
    sizes = rows.groupBy("filename").agg(F.count(F.lit(1)).alias("n_rows"))
    # A table whose records are all empty has no columns, but rows.
    tables = sizes.join(table_columns(rows, max_columns), "filename", "left").select(
        "filename", F.coalesce("columns", F.array().cast("array<string>")).alias("columns"), "n_rows"
    ).checkpoint()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.ceil(F.col("n_rows") / rows_per_file).cast("int")
    share_task = F.pmod(F.xxhash64("filename", "_share"), F.lit(parts)).cast("int").alias("_task")
    known = tables.select("filename", "columns", shares.alias("_shares"))
    body = lookup_join(rows, known, ["filename"], "inner").withColumn(
        "_share", F.pmod(F.monotonically_increasing_id(), "_shares").cast("int")
    )
    cells = F.transform("columns", lambda c: cell(F.element_at("record", c)))
    body = body.select("filename", share_task, F.lit(1).alias("_kind"), _line(cells).alias("value"))
    heads = known.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    # One per table and task: the task writes one file of the table.
    heads = heads.select("filename", share_task, F.lit(0).alias("_kind"),
                         _line(F.transform("columns", cell)).alias("value")).distinct()
    lines = heads.unionByName(body).repartitionById(parts, F.col("_task"))
    # A folder's name must not be NULL, else the writer would sort by it anew.
    folder = F.coalesce("filename", F.lit("")).alias("filename")
    lines.select(folder, "_kind", "value").sortWithinPartitions("filename", "_kind").select("filename", "value").write.mode(
        "overwrite"
    ).partitionBy("filename").text(path)
    return tables


def rebuild_tables(
    df: DataFrame, key_columns: Sequence[str], raw_column: str, path: str, **limits
) -> tuple[DataFrame, DataFrame]:
    """Rebuild all tables of a dump as CSV below ``path``: (the tables as ``write_tables`` gives them, quarantined
    rows)."""
    records, quarantine = parse_records(df, key_columns, raw_column)
    return write_tables(records, path, **limits), quarantine
