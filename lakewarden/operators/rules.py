"""Data-quality rules: loading them and turning each into a Spark predicate."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions.formats import matches_strftime, parse_date
from lakewarden.functions.json_schema import conforms


@dataclass(frozen=True)
class Rule:
    """One configured rule."""

    seq: int
    rule_type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    action: str = "log"
    error: str | None = None

    @property
    def column(self) -> str | None:
        return self.params.get("column")

    @property
    def mostly(self) -> float:
        return float(self.params.get("mostly", 1.0))


def make_rules(specs: Iterable[tuple]) -> list[Rule]:
    """Rules from (rule_type, parameters, action) tuples, numbered from 1."""
    return [Rule(i, kind, dict(params), action) for i, (kind, params, action) in enumerate(specs, 1)]


def load_rules(rules_df: DataFrame, bri: str) -> list[Rule]:
    """The rules of one business rule identifier, in order of ``id``.

    This reads the configuration of one identifier to the driver. Parameters that are
    not a JSON object give a rule that reports the exception.
    """
    rows = (
        rules_df.filter(F.col("bri") == bri)
        .select("id", "rule_type", "rule_parameters", "action")
        .orderBy("id")
        .collect()
    )
    rules = []
    for row in rows:
        try:
            params = json.loads(row["rule_parameters"])
            if not isinstance(params, dict):
                raise ValueError("rule parameters must be a JSON object")
            rules.append(Rule(row["id"], row["rule_type"], params, row["action"]))
        except (TypeError, ValueError) as exc:
            rules.append(Rule(row["id"], row["rule_type"], {}, row["action"], str(exc)))
    return rules


@dataclass(frozen=True)
class Check:
    """A compiled rule.

    kind is ``rows`` (``unexpected`` decides row by row), ``unique``, ``ordered``
    (compare with the previous value), ``count`` (a number within bounds), ``schema``
    (known without reading data) or ``error``.
    """

    rule: Rule
    kind: str
    unexpected: Column | None = None
    over_all_rows: bool = False
    rising: bool = True
    order_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    success: bool | None = None
    error: str | None = None

    @property
    def by_row(self) -> bool:
        return self.kind in ("rows", "unique", "ordered")


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


class RuleError(ValueError):
    """A rule that cannot be evaluated on this table."""


def _need(rule: Rule, *names: str):
    """The first parameter present among ``names``."""
    for name in names:
        if rule.params.get(name) is not None:
            return rule.params[name]
    raise RuleError(f"missing parameter: {names[0]}")


def _optional(rule: Rule, *names: str):
    return next((rule.params[n] for n in names if rule.params.get(n) is not None), None)


def _constant(spark: SparkSession, value, dtype: T.DataType) -> Column:
    """``value`` as a literal comparable with a column of type ``dtype``."""
    if isinstance(dtype, NUMERIC):
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise RuleError(f"not a number: {value!r}")
        return F.lit(value)
    if isinstance(dtype, TEMPORAL):
        name = dtype.simpleString()
        probe = spark.sql(f"SELECT try_cast(:v AS {name}) IS NULL AS bad", args={"v": str(value)})
        if probe.first()["bad"]:
            raise RuleError(f"not a {name}: {value!r}")
        return F.lit(str(value)).cast(dtype)
    if isinstance(dtype, T.BooleanType) and not isinstance(value, bool):
        raise RuleError(f"not a boolean: {value!r}")
    if isinstance(dtype, T.StringType) and not isinstance(value, str):
        raise RuleError(f"not a string: {value!r}")
    return F.lit(value)


def _number(rule: Rule, name: str) -> float | None:
    value = _optional(rule, name)
    if isinstance(value, bool) or not isinstance(value, (int, float, type(None))):
        raise RuleError(f"not a number: {value!r}")
    return value


def _check_default(spark: SparkSession, rule: Rule, dtype: T.DataType) -> None:
    """A replacement must fit the column."""
    default = rule.params.get("default")
    if rule.action != "transform" or default is None:
        return
    probe = spark.range(1).select(F.lit(default).try_cast(dtype).isNull().alias("bad"))
    if probe.first()["bad"]:
        raise RuleError(f"not a {dtype.simpleString()}: {default!r}")


UNORDERED = (T.MapType, T.VariantType)


def _outside(spark, rule, value: Column, dtype, low, high) -> Column:
    strict = bool(rule.params.get("strict_bounds", False))
    strict_low = strict or bool(rule.params.get("strict_min", False))
    strict_high = strict or bool(rule.params.get("strict_max", False))
    if low is None and high is None:
        raise RuleError("missing parameter: min_value or max_value")
    outside = F.lit(False)
    if low is not None:
        bound = _constant(spark, low, dtype)
        outside = outside | ((value <= bound) if strict_low else (value < bound))
    if high is not None:
        bound = _constant(spark, high, dtype)
        outside = outside | ((value >= bound) if strict_high else (value > bound))
    return outside


def _names(value) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def _as_day(value: Column, dtype: T.DataType) -> Column:
    return value.try_cast("date") if isinstance(dtype, T.StringType) else value.cast("date")


def compile_rule(df: DataFrame, rule: Rule) -> Check:
    """Compile one rule for this table; a rule that cannot be compiled is an error check."""
    if rule.error is not None:
        return Check(rule, "error", error=rule.error)
    try:
        check = _compile(df, rule)
        if check.unexpected is not None:
            df.select(check.unexpected)  # analysed here, so that it fails here
        return check
    except Exception as exc:  # a broken rule must not stop the others
        return Check(rule, "error", error=str(exc).splitlines()[0])


def _compile(df: DataFrame, rule: Rule) -> Check:
    spark, kind = df.sparkSession, rule.rule_type
    _number(rule, "mostly")
    if kind == "expect_table_row_count_to_be_between":
        low, high = _number(rule, "min_value"), _number(rule, "max_value")
        return Check(rule, "count", low=low, high=high)
    if kind == "expect_table_column_count_to_equal":
        return Check(rule, "schema", success=len(df.columns) == int(_need(rule, "value")))
    if kind not in COLUMN_RULES:
        raise RuleError(f"Unsupported rule type: {kind}")

    name = _need(rule, "column")
    if name not in df.columns:
        raise RuleError(f"no such column: {name}")
    dtype, value = df.schema[name].dataType, F.col(f"`{name}`")
    text = value if isinstance(dtype, T.StringType) else value.cast("string")
    _check_default(spark, rule, dtype)

    if kind == "expect_column_values_to_be_of_type":
        wanted = str(_need(rule, "type", "type_"))
        known = {dtype.simpleString(), type(dtype).__name__.lower(), dtype.typeName()}
        return Check(rule, "schema", success=wanted.lower() in known)
    if kind == "expect_column_null_count_to_be_between":
        low, high = _number(rule, "min_value"), _number(rule, "max_value")
        return Check(rule, "count", unexpected=value.isNull(), low=low, high=high)
    if kind == "expect_column_values_to_not_be_null":
        return Check(rule, "rows", value.isNull(), over_all_rows=True)
    if kind == "expect_column_values_to_be_unique":
        if isinstance(dtype, UNORDERED):
            raise RuleError(f"values of type {dtype.simpleString()} cannot be compared")
        return Check(rule, "unique")
    if kind in ("expect_column_values_to_be_increasing", "expect_column_values_to_be_decreasing"):
        order, part = _names(_need(rule, "order_by")), _names(rule.params.get("partition_by"))
        absent = [c for c in (*order, *part) if c not in df.columns]
        if absent:
            raise RuleError(f"no such column: {absent[0]}")
        if any(isinstance(df.schema[c].dataType, UNORDERED) for c in (name, *order, *part)):
            raise RuleError("values of this type have no order")
        return Check(
            rule, "ordered", rising=kind.endswith("increasing"), order_by=order, partition_by=part
        )

    if kind == "expect_column_values_to_be_between":
        low, high = _optional(rule, "min", "min_value"), _optional(rule, "max", "max_value")
        bad = _outside(spark, rule, value, dtype, low, high)
    elif kind == "expect_column_values_to_be_greater_than_or_equal_to":
        bad = value < _constant(spark, _need(rule, "min_value"), dtype)
    elif kind == "expect_column_value_lengths_to_be_between":
        low, high = _optional(rule, "min_value"), _optional(rule, "max_value")
        bad = _outside(spark, rule, F.char_length(text), T.IntegerType(), low, high)
    elif kind == "expect_column_values_to_match_regex":
        pattern = str(_need(rule, "regex"))
        spark.sql("SELECT '' RLIKE :p", args={"p": pattern}).first()  # fails if malformed
        bad = ~text.rlike(pattern)
    elif kind in ("expect_column_values_to_be_in_set", "expect_column_values_to_not_be_in_set"):
        values = [v for v in _need(rule, "values", "value_set") if v is not None]
        inside = value.isin([_constant(spark, v, dtype) for v in values]) if values else F.lit(False)
        bad = inside if kind.endswith("not_be_in_set") else ~inside
    elif kind == "expect_column_values_to_match_strftime_format":
        bad = ~matches_strftime(text, str(_need(rule, "format", "strftime_format")))
    elif kind == "expect_column_values_to_be_dateutil_parseable":
        bad = parse_date(text).isNull()
    elif kind == "expect_column_values_to_be_json_parseable":
        bad = F.try_parse_json(text).isNull()
    elif kind == "expect_column_values_to_match_json_schema":
        schema = _need(rule, "schema", "json_schema")
        schema = json.loads(schema) if isinstance(schema, str) else schema
        bad = ~conforms(F.try_parse_json(text), schema)
    elif kind == "expect_column_values_to_be_within_last_n_days":
        as_of = rule.params.get("as_of")
        today = F.current_date() if as_of is None else _constant(spark, as_of, T.DateType())
        day = _as_day(value, dtype)
        bad = day.isNull() | (day < F.date_sub(today, int(_need(rule, "n")))) | (day > today)
    else:  # expect_column_values_to_be_in_past
        kind_of_time = dtype if isinstance(dtype, TEMPORAL) else T.TimestampType()
        moment = value if isinstance(dtype, TEMPORAL) else text.try_cast("timestamp")
        as_of = rule.params.get("as_of")
        if as_of is not None:
            now = _constant(spark, as_of, kind_of_time)
        else:
            now = F.current_timestamp().cast(kind_of_time)
        bad = moment.isNull() | (moment >= now)
    return Check(rule, "rows", value.isNotNull() & F.coalesce(bad, F.lit(True)))


# The rule types that concern one column.
COLUMN_RULES = {
    "expect_column_values_to_be_between",
    "expect_column_values_to_match_regex",
    "expect_column_values_to_not_be_null",
    "expect_column_values_to_be_unique",
    "expect_column_values_to_be_in_set",
    "expect_column_values_to_not_be_in_set",
    "expect_column_values_to_be_of_type",
    "expect_column_values_to_match_strftime_format",
    "expect_column_values_to_be_increasing",
    "expect_column_values_to_be_decreasing",
    "expect_column_values_to_be_dateutil_parseable",
    "expect_column_values_to_be_json_parseable",
    "expect_column_values_to_match_json_schema",
    "expect_column_null_count_to_be_between",
    "expect_column_values_to_be_within_last_n_days",
    "expect_column_values_to_be_greater_than_or_equal_to",
    "expect_column_value_lengths_to_be_between",
    "expect_column_values_to_be_in_past",
}
