"""Column profiles, distinct counts and value histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def type_class(dtype: T.DataType) -> str:
    """Integral, Fractional, String, DateTime, Date, Boolean or Other."""
    if isinstance(dtype, INTEGRAL):
        return "Integral"
    if isinstance(dtype, FRACTIONAL):
        return "Fractional"
    if isinstance(dtype, T.StringType):
        return "String"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "DateTime"
    if isinstance(dtype, T.DateType):
        return "Date"
    return "Boolean" if isinstance(dtype, T.BooleanType) else "Other"


def is_numeric(field: T.StructField) -> bool:
    return type_class(field.dataType) in ("Integral", "Fractional")


def is_temporal(field: T.StructField) -> bool:
    return type_class(field.dataType) in ("DateTime", "Date")


def _measured(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


# A sketch of so many items holds all values of a column that has at most three quarters as many, with exact counts.
SKETCH_ITEMS = 64
# The estimated number of distinct values up to which that is so without doubt.
SURELY_HELD = 30


def few_values(column: str, most: int) -> Column:
    """The distinct values of a text column, NULL included, if they are at most ``most`` (20 at most); else NULL.
    An aggregate of two sketches of fixed size, yet the result is exact."""
    quoted = column.replace("`", "``")
    items = F.expr(f"approx_top_k(`{quoted}`, {most + 1}, {SKETCH_ITEMS})")
    values = F.transform(items, lambda x: x["item"])
    near = F.approx_count_distinct(F.col(f"`{quoted}`"), 0.02) <= SURELY_HELD
    return F.when(near & (F.size(items) <= most), values)


def wide_profile(df: DataFrame, few: int = 0) -> DataFrame:
    """All statistics of all columns in one row, by one aggregate over one scan.

    ``n`` is the row count; column i has ``c{i}`` (non-NULL values) and, by its type,
    ``lo{i}``, ``hi{i}``, ``mean{i}``, ``sd{i}``, ``minlen{i}``, ``maxlen{i}``, and with ``few``
    texts have ``few{i}``, their distinct values if there are not more than that.
    """
    sums = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(df.schema.fields):
        value = _measured(field)
        sums.append(F.count(F.col(f"`{field.name}`")).alias(f"c{i}"))
        if is_numeric(field) or is_temporal(field):
            sums += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
        if is_numeric(field):
            sums += [F.avg(value).alias(f"mean{i}"), F.stddev_pop(value).alias(f"sd{i}")]
        if type_class(field.dataType) == "String":
            length = F.char_length(value)
            sums += [F.min(length).alias(f"minlen{i}"), F.max(length).alias(f"maxlen{i}")]
            if few:
                sums.append(few_values(field.name, few).alias(f"few{i}"))
    return df.agg(*sums)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type class, completeness and the statistics of its type.

    minimum, maximum, mean and std_dev (of the population) are for numbers, first_time and
    last_time for dates and timestamps, the lengths for strings.
    """
    wide = wide_profile(df)
    present = set(wide.columns)

    def stat(name: str, i: int, kind: str, wanted: bool) -> Column:
        column = F.col(f"{name}{i}") if wanted and f"{name}{i}" in present else F.lit(None)
        return column.cast(kind)

    rows = []
    for i, field in enumerate(df.schema.fields):
        number, time = is_numeric(field), is_temporal(field)
        layout = "yyyy-MM-dd" if isinstance(field.dataType, T.DateType) else "yyyy-MM-dd HH:mm:ss.SSSSSS"
        rows.append(
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(field.name).alias("column_name"),
                F.lit(type_class(field.dataType)).alias("data_type"),
                (F.col(f"c{i}") / F.when(F.col("n") > 0, F.col("n"))).alias("completeness"),
                stat("lo", i, "double", number).alias("minimum"),
                stat("hi", i, "double", number).alias("maximum"),
                stat("mean", i, "double", True).alias("mean"),
                stat("sd", i, "double", True).alias("std_dev"),
                (F.date_format(f"lo{i}", layout) if time else F.lit(None).cast("string")).alias("first_time"),
                (F.date_format(f"hi{i}", layout) if time else F.lit(None).cast("string")).alias("last_time"),
                stat("minlen", i, "int", True).alias("min_length"),
                stat("maxlen", i, "int", True).alias("max_length"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """(ordinal, column_name, n_distinct), NULL counted as one value, in one job.

    Exact counts shuffle the distinct values of every column; the approximate form keeps
    one fixed-size sketch per column and is the one for very large tables.
    """
    names = list(columns or df.columns)
    sums, rows = [], []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, NESTED):
            value = F.to_json(value)
        count = F.approx_count_distinct(value, 0.01) if approximate else F.count_distinct(value)
        null = F.coalesce(F.max(value.isNull().cast("bigint")), F.lit(0))
        sums.append((count + null).alias(f"d{i}"))
        rows.append(
            F.struct(
                F.lit(df.columns.index(name)).alias("ordinal"),
                F.lit(name).alias("column_name"),
                F.col(f"d{i}").alias("n_distinct"),
            )
        )
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for every non-NULL value of the given columns.

    All columns share one scan; equal values are counted before the shuffle.
    """
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.explode(cells).alias("c"))
        .select("c.*")
        .filter("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
