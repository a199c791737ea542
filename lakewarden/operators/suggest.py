"""Rule suggestions from a column profile, under two rule vocabularies."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakewarden.operators.profiling import is_numeric, is_temporal, type_class, wide_profile
from lakewarden.operators.rules import Rule
from lakewarden.settings import small_frame

# Fixed values.
SAMPLE_SEED = 42
LOW_CARDINALITY = 20
NOT_NULL_SHARE = 0.95

SUGGESTIONS = T.StructType(
    [
        T.StructField("rule_seq", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("dbt_rule_name", T.StringType()),
        T.StructField("ge_rule_name", T.StringType()),
        T.StructField("parameters", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("mostly", T.DoubleType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("min_time", T.StringType()),
        T.StructField("max_time", T.StringType()),
        T.StructField("value_set", T.ArrayType(T.StringType())),
    ]
)


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


class _Suggestions:
    def __init__(self, table_name: str):
        self.table_name = table_name
        self.rows = []

    def add(self, column, dbt, ge, description, **params):
        low = params.get("min_value", params.get("min"))
        high = params.get("max_value", params.get("max"))
        timed = isinstance(low, str)
        name = {} if column == "ALL_COLUMNS" else {"column": column}
        self.rows.append(
            (
                len(self.rows) + 1,
                self.table_name,
                column,
                dbt,
                f"expect_{ge}",
                json.dumps({**name, **params}),
                description,
                params.get("mostly"),
                None if timed or low is None else float(low),
                None if timed or high is None else float(high),
                low if timed else None,
                high if timed else None,
                params.get("values"),
            )
        )


def suggest_rules(
    df: DataFrame, table_name: str, sample_size: int | None = None
) -> DataFrame:
    """Suggested rules of a table: per column, then the row count, then the unique key.

    The whole table is profiled; only if the caller gives ``sample_size``, larger tables are
    profiled on a seeded sample. One scan gives all statistics and, by sketches, the values of columns with
    few distinct ones; one row reaches the driver.
    """
    spark, total, sample = df.sparkSession, None, df
    if sample_size is not None:
        total = df.count()
        if total > sample_size:
            sample = df.sample(fraction=sample_size / total, seed=SAMPLE_SEED)
    # NULL counts as a value.
    stats = wide_profile(sample, few=LOW_CARDINALITY - 1).first().asDict()
    total = stats["n"] if total is None else total

    out = _Suggestions(table_name)
    for i, field in enumerate(df.schema.fields):
        name = field.name
        out.add(
            name, "not_null", "column_values_to_not_be_null",
            f"Values in {name} should not be null",
            mostly=NOT_NULL_SHARE,
        )
        low, high = _plain(stats.get(f"lo{i}")), _plain(stats.get(f"hi{i}"))
        if is_numeric(field) and low is not None:
            out.add(
                name, "relationships.range", "column_values_to_be_between",
                f"Values in {name} should be between {low:.2f} and {high:.2f}",
                min=low, max=high, strict_bounds=False, mostly=0.95,
            )
            if low >= 0:
                out.add(
                    name, "expression_is_true", "column_values_to_be_greater_than_or_equal_to",
                    f"Values in {name} should be non-negative",
                    min_value=0, mostly=0.98,
                )
        elif type_class(field.dataType) == "String" and stats[f"minlen{i}"] is not None:
            short, long = stats[f"minlen{i}"], stats[f"maxlen{i}"]
            out.add(
                name, "expression_is_true", "column_value_lengths_to_be_between",
                f"String length of {name} should be between {short} and {long}",
                min_value=short, max_value=long, mostly=0.95,
            )
            if stats[f"few{i}"] is not None:
                accepted = sorted(v for v in stats[f"few{i}"] if v is not None)
                out.add(
                    name, "accepted_values", "column_values_to_be_in_set",
                    f"Values in {name} should be in {accepted}",
                    values=accepted, mostly=0.99,
                )
        elif is_temporal(field) and low is not None:
            out.add(
                name, "expression_is_true", "column_values_to_be_between",
                f"Dates in {name} should be between {low} and {high}",
                min_value=str(low), max_value=str(high), mostly=0.95,
            )
            out.add(
                name, "expression_is_true", "column_values_to_be_in_past",
                f"Dates in {name} should be in the past",
                mostly=0.99,
            )
    fewest, most = total * 0.8, total * 1.2
    out.add(
        "ALL_COLUMNS", "row_count", "table_row_count_to_be_between",
        f"Table {table_name} should have between {int(fewest)} and {int(most)} rows",
        min_value=fewest, max_value=most,
    )
    key = next((c for c in df.columns if c.lower() in ("id", "pk")), None)
    if key:
        out.add(
            key, "unique", "column_values_to_be_unique", f"Values in {key} should be unique"
        )
    return small_frame(spark, out.rows, SUGGESTIONS)


def dbt_view(suggestions: DataFrame) -> DataFrame:
    return suggestions.select(
        "table_name", "column_name", "dbt_rule_name", "parameters", "description"
    )


def ge_view(suggestions: DataFrame) -> DataFrame:
    return suggestions.select(
        "table_name", "column_name", "ge_rule_name", "parameters", "description"
    )


def as_rules(suggestions: DataFrame, action: str = "log") -> list[Rule]:
    """The suggestions as rules for the evaluator."""
    rows = suggestions.select("rule_seq", "ge_rule_name", "parameters").orderBy("rule_seq")
    return [
        Rule(r["rule_seq"], r["ge_rule_name"], json.loads(r["parameters"]), action)
        for r in rows.collect()
    ]
