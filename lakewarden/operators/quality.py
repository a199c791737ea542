"""Evaluate data-quality rules and act on the rows that fail them.

All row rules of a table share one aggregate over one scan. A uniqueness rule adds one
grouped count and an ordering rule one ordered scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.rules import Check, Rule, compile_rule, load_rules
from lakewarden.operators.skew import lookup_join, previous
from lakewarden.settings import ROWS_PER_GROUP, work_dir

COUNTS = T.StructType(
    [
        T.StructField("rule_seq", T.IntegerType()),
        T.StructField("element_count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("rule_type", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("exception", T.StringType()),
    ]
)


def _result(check: Check, elements, missing, unexpected, success) -> Column:
    rule = check.rule
    values = [
        F.lit(rule.seq),
        elements,
        missing,
        unexpected,
        success,
        F.lit(rule.rule_type),
        F.lit(rule.column),
        F.lit(rule.action),
        F.lit(check.error),
    ]
    return F.struct(
        *[
            (F.lit(None) if v is None else v).cast(f.dataType).alias(f.name)
            for v, f in zip(values, COUNTS.fields)
        ]
    )


def _passes(check: Check, elements: Column, unexpected: Column) -> Column:
    """The share of expected values reaches ``mostly`` (always so for no values)."""
    share = (elements - unexpected) / F.when(elements > 0, elements)
    return F.coalesce(share >= F.lit(check.rule.mostly), F.lit(True))


def _within(check: Check, n: Column) -> Column:
    inside = F.lit(True)
    if check.low is not None:
        inside = inside & (n >= F.lit(check.low))
    if check.high is not None:
        inside = inside & (n <= F.lit(check.high))
    return inside


def _scan_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One aggregate for all row rules and counts."""
    sums = [F.count(F.lit(1)).alias("n")]
    results = []
    for c in checks:
        seq = c.rule.seq
        if c.kind == "count":
            if c.unexpected is None:
                results.append(_result(c, F.col("n"), None, None, _within(c, F.col("n"))))
            else:
                sums.append(F.count_if(c.unexpected).alias(f"m{seq}"))
                nulls = F.col(f"m{seq}")
                results.append(_result(c, F.col("n"), nulls, None, _within(c, nulls)))
            continue
        sums.append(F.count_if(c.unexpected).alias(f"u{seq}"))
        sums.append(F.count_if(F.col(f"`{c.rule.column}`").isNull()).alias(f"m{seq}"))
        unexpected, missing = F.col(f"u{seq}"), F.col(f"m{seq}")
        judged = F.col("n") if c.over_all_rows else F.col("n") - missing
        results.append(
            _result(c, F.col("n"), missing, unexpected, _passes(c, judged, unexpected))
        )
    return df.agg(*sums).select(F.explode(F.array(*results)).alias("r")).select("r.*")


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _unique_counts(df: DataFrame, check: Check) -> DataFrame:
    known = F.col("value").isNotNull()
    totals = _value_counts(df, check.rule.column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("m"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("u"),
    )
    passes = _passes(check, F.col("n") - F.col("m"), F.col("u"))
    result = _result(check, F.col("n"), F.col("m"), F.col("u"), passes)
    return totals.select(result.alias("r")).select("r.*")


def _with_order_flag(df: DataFrame, check: Check, flag: str, rows_per_group: int) -> DataFrame:
    value = F.col(f"`{check.rule.column}`")
    out = previous(
        df, check.partition_by, check.order_by, {f"_p_{flag}": value}, rows_per_group
    )
    prior = F.col(f"_p_{flag}")
    wrong = value < prior if check.rising else value > prior
    return out.withColumn(flag, F.coalesce(wrong, F.lit(False))).drop(f"_p_{flag}")


def _order_source(df: DataFrame, check: Check, flag: str, rows_per_group: int) -> DataFrame:
    """Only the columns that the ordering rule needs take part in its shuffle."""
    needed = dict.fromkeys([check.rule.column, *check.order_by, *check.partition_by])
    return _with_order_flag(df.select(*[f"`{c}`" for c in needed]), check, flag, rows_per_group)


def _ordered_counts(df: DataFrame, check: Check, rows_per_group: int) -> DataFrame:
    value = F.col(f"`{check.rule.column}`")
    totals = _order_source(df, check, "_bad", rows_per_group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(value.isNull()).alias("m"),
        F.count_if("_bad").alias("u"),
    )
    passes = _passes(check, F.col("n") - F.col("m"), F.col("u"))
    result = _result(check, F.col("n"), F.col("m"), F.col("u"), passes)
    return totals.select(result.alias("r")).select("r.*")


def _as_text(df: DataFrame, column: str) -> Column:
    dtype, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def _examples(df: DataFrame, checks: Sequence[Check], n: int, rows_per_group: int) -> DataFrame:
    """The ``n`` smallest distinct unexpected values of each rule, as text."""
    parts = []
    by_row = [c for c in checks if c.kind == "rows" and not c.over_all_rows]
    if by_row:
        failed = F.array_compact(
            F.array(
                *[
                    F.when(
                        c.unexpected,
                        F.struct(
                            F.lit(c.rule.seq).alias("rule_seq"),
                            _as_text(df, c.rule.column).alias("value"),
                        ),
                    )
                    for c in by_row
                ]
            )
        )
        parts.append(df.select(F.explode(failed).alias("f")).select("f.*"))
    for c in checks:
        if c.kind == "unique":
            twice = _value_counts(df, c.rule.column).filter("value IS NOT NULL AND n > 1")
            text = _as_text(twice, "value")
            parts.append(twice.select(F.lit(c.rule.seq).alias("rule_seq"), text.alias("value")))
        elif c.kind == "ordered":
            wrong = _order_source(df, c, "_bad", rows_per_group).filter("_bad")
            text = _as_text(df, c.rule.column)
            parts.append(wrong.select(F.lit(c.rule.seq).alias("rule_seq"), text.alias("value")))
    if not parts:
        return None
    ranked = Window.partitionBy("rule_seq").orderBy("value")
    return (
        reduce(DataFrame.unionByName, parts)
        .distinct()
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= n)
        .groupBy("rule_seq")
        .agg(F.sort_array(F.collect_list("value")).alias("partial_unexpected"))
    )


def compile_rules(df: DataFrame, rules: Sequence[Rule]) -> list[Check]:
    return [compile_rule(df, rule) for rule in rules]


def evaluate(
    df: DataFrame,
    rules: Sequence[Rule],
    examples: int = 20,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """One result row per rule.

    NULLs are missing, not unexpected, except for the not-null rule. A rule that cannot
    be evaluated has success FALSE and an exception text.
    """
    checks = compile_rules(df, rules)
    scans = [c for c in checks if c.kind in ("rows", "count")]
    known = [c for c in checks if c.kind in ("schema", "error")]
    parts = []
    if scans:
        parts.append(_scan_counts(df, scans))
    parts += [_unique_counts(df, c) for c in checks if c.kind == "unique"]
    parts += [_ordered_counts(df, c, rows_per_group) for c in checks if c.kind == "ordered"]
    if known or not parts:
        rows = [_result(c, None, None, None, F.lit(bool(c.success))) for c in known]
        results = F.array(*rows).cast(T.ArrayType(COUNTS))
        parts.append(
            df.sparkSession.range(1).select(F.explode(results).alias("r")).select("r.*")
        )
    counts = reduce(DataFrame.unionByName, parts)
    values = _examples(df, checks, examples, rows_per_group) if examples else None
    if values is None:
        counts = counts.withColumn("partial_unexpected", F.lit(None).cast("array<string>"))
    else:
        counts = counts.join(values, "rule_seq", "left")
    counted = F.col("unexpected_count").isNotNull()
    judged = F.col("element_count") - F.when(
        F.col("rule_type") == "expect_column_values_to_not_be_null", 0
    ).otherwise(F.col("missing_count"))
    return counts.select(
        "rule_seq",
        "rule_type",
        "column_name",
        "success",
        "element_count",
        "missing_count",
        "unexpected_count",
        F.when(judged > 0, F.col("unexpected_count") / judged).alias("unexpected_fraction"),
        F.when(
            counted, F.coalesce("partial_unexpected", F.array().cast("array<string>"))
        ).alias("partial_unexpected"),
        "action",
        "exception",
    )


def flag_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    rows_per_group: int = ROWS_PER_GROUP,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Add ``failed_rules``, the numbers of the row-level rules that the row fails."""
    work_dir(df.sparkSession)
    checks = [c for c in compile_rules(df, rules) if c.by_row]
    limits = {} if max_broadcast_rows is None else {"max_broadcast_rows": max_broadcast_rows}
    out, flags = df, []
    for c in checks:
        flag = f"_bad{c.rule.seq}"
        if c.kind == "rows":
            flags.append((c, c.unexpected))
            continue
        if c.kind == "unique":
            # Counted once: the lookup, its size and its hot keys all come from this table.
            twice = (
                _value_counts(df, c.rule.column)
                .filter("value IS NOT NULL AND n > 1")
                .withColumnRenamed("value", c.rule.column)
                .checkpoint()
            )
            out = lookup_join(
                out,
                twice.select(f"`{c.rule.column}`", F.lit(True).alias(flag)),
                [c.rule.column],
                "left",
                rows_per_group=rows_per_group,
                hot=twice.filter(F.col("n") > rows_per_group).withColumnRenamed("n", "_rows"),
                **limits,
            )
        else:
            out = _with_order_flag(out, c, flag, rows_per_group)
        flags.append((c, F.coalesce(F.col(flag), F.lit(False))))
    failed = F.array_compact(
        F.array(*[F.when(bad, F.lit(c.rule.seq)) for c, bad in flags]).cast("array<int>")
    )
    return out.select(*[f"`{c}`" for c in df.columns], failed.alias("failed_rules"))


def act(
    df: DataFrame,
    rules: Sequence[Rule],
    rows_per_group: int = ROWS_PER_GROUP,
    max_broadcast_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(cleaned, quarantine).

    Rows that fail a ``reject`` rule go to the quarantine with the numbers of those
    rules; values that fail a ``transform`` rule are replaced. All rules look at the
    original values. Rules on the whole table, and rules that cannot be evaluated (a default that
    does not fit the column included), have no rows to act on.
    """
    acting = [r for r in rules if r.action in ("reject", "transform")]
    broken = {c.rule.seq for c in compile_rules(df, acting) if c.kind == "error"}
    acting = [r for r in acting if r.seq not in broken]
    flagged = flag_rows(df, acting, rows_per_group, max_broadcast_rows)
    rejecting = [r.seq for r in acting if r.action == "reject"]
    rejected = F.filter("failed_rules", lambda s: s.isin(rejecting) if rejecting else F.lit(False))
    columns = []
    for name in df.columns:
        dtype, value = df.schema[name].dataType, F.col(f"`{name}`")
        for rule in acting:
            if rule.action == "transform" and rule.column == name:
                standard = "DEFAULT_VALUE" if isinstance(dtype, T.StringType) else None
                default = F.lit(rule.params.get("default", standard)).cast(dtype)
                bad = F.array_contains("failed_rules", rule.seq)
                value = F.when(bad, default).otherwise(value)
        columns.append(value.alias(name))
    cleaned = flagged.filter(F.size(rejected) == 0).select(*columns)
    quarantine = flagged.withColumn("failed_rules", rejected).filter(F.size("failed_rules") > 0)
    return cleaned, quarantine


def run_rules(
    df: DataFrame, rules_df: DataFrame, bri: str, rows_per_group: int = ROWS_PER_GROUP
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cleaned, quarantine, report) for the rules of one business rule identifier."""
    rules = load_rules(rules_df, bri)
    cleaned, quarantine = act(df, rules, rows_per_group)
    return cleaned, quarantine, evaluate(df, rules, rows_per_group=rows_per_group)
