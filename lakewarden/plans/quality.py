"""Data-quality queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.operators.quality import act, evaluate, run_rules
from lakewarden.operators.rules import make_rules
from lakewarden.plans.catalogue import query, read


def _flat(report: DataFrame) -> DataFrame:
    return report.select(
        "rule_seq",
        "rule_type",
        "column_name",
        "success",
        "element_count",
        "missing_count",
        "unexpected_count",
        F.round("unexpected_fraction", 9).alias("unexpected_fraction"),
        F.array_join("partial_unexpected", "|").alias("partial_unexpected"),
        "action",
    )


def _report(df: DataFrame, *specs) -> DataFrame:
    return _flat(evaluate(df, make_rules((f"expect_{k}", p, "log") for k, p in specs)))


def _rule_sql(seq, kind, column, source, bad, mostly=1.0, over_all=False, action="log") -> str:
    """The SQL of one result row: ``bad`` is the condition of an unexpected value."""
    judged = "n" if over_all else "n - m"
    return f"""
    SELECT CAST({seq} AS INTEGER) AS rule_seq, 'expect_{kind}' AS rule_type,
           '{column}' AS column_name,
           coalesce(({judged} - u) / nullif(CAST({judged} AS DOUBLE), 0) >= {mostly}, true) AS success,
           n AS element_count, m AS missing_count, u AS unexpected_count,
           round(u / nullif(CAST({judged} AS DOUBLE), 0), 9) AS unexpected_fraction,
           coalesce((SELECT string_agg(v, '|' ORDER BY v) FROM (
               SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM {source}
               WHERE ({bad}) AND {column} IS NOT NULL ORDER BY v LIMIT 20)), '') AS partial_unexpected,
           '{action}' AS action
    FROM (SELECT count(*) AS n, count(*) FILTER ({column} IS NULL) AS m,
                 count(*) FILTER ({bad}) AS u FROM {source})"""


def _all(*parts) -> str:
    return "\nUNION ALL\n".join(parts)


@query(_all(
    _rule_sql(1, "column_values_to_be_between", "l_quantity", "lineitem",
              "l_quantity < 2 OR l_quantity > 48", 0.9),
    _rule_sql(2, "column_values_to_be_between", "l_discount", "lineitem", "l_discount > 0.09"),
    _rule_sql(3, "column_values_to_be_between", "l_tax", "lineitem", "l_tax <= 0 OR l_tax >= 0.08"),
))
def dq_between(spark, folder):
    return _report(
        read(spark, folder, "lineitem"),
        ("column_values_to_be_between",
         {"column": "l_quantity", "min_value": 2, "max_value": 48, "mostly": 0.9}),
        ("column_values_to_be_between", {"column": "l_discount", "max": 0.09}),
        ("column_values_to_be_between",
         {"column": "l_tax", "min": 0, "max": 0.08, "strict_bounds": True}),
    )


@query(_all(
    _rule_sql(1, "column_values_to_match_regex", "c_name", "customer",
              "NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$')"),
    _rule_sql(2, "column_values_to_match_regex", "c_mktsegment", "customer",
              "NOT regexp_matches(c_mktsegment, 'I')", 0.5),
))
def dq_regex(spark, folder):
    return _report(
        read(spark, folder, "customer"),
        ("column_values_to_match_regex",
         {"column": "c_name", "regex": "^Customer#[0-9]*[02468]$"}),
        ("column_values_to_match_regex", {"column": "c_mktsegment", "regex": "I", "mostly": 0.5}),
    )


_HOLES = "(SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)"


def _with_holes(spark, folder):
    orders = read(spark, folder, "orders")
    return orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


@query(_all(
    _rule_sql(1, "column_values_to_not_be_null", "o_orderpriority", _HOLES,
              "o_orderpriority IS NULL", 1.0, True),
    _rule_sql(2, "column_values_to_not_be_null", "o_orderpriority", _HOLES,
              "o_orderpriority IS NULL", 0.6, True),
    _rule_sql(3, "column_values_to_not_be_null", "o_custkey", _HOLES, "o_custkey IS NULL", 1.0, True),
))
def dq_not_null(spark, folder):
    return _report(
        _with_holes(spark, folder),
        ("column_values_to_not_be_null", {"column": "o_orderpriority"}),
        ("column_values_to_not_be_null", {"column": "o_orderpriority", "mostly": 0.6}),
        ("column_values_to_not_be_null", {"column": "o_custkey"}),
    )


_BALANCES = "(SELECT *, count(*) OVER (PARTITION BY c_acctbal) AS same FROM customer)"


@query(_all(
    _rule_sql(1, "column_values_to_be_unique", "c_acctbal", _BALANCES, "same > 1"),
    _rule_sql(2, "column_values_to_be_unique", "c_custkey", "customer", "false"),
))
def dq_unique(spark, folder):
    return _report(
        read(spark, folder, "customer"),
        ("column_values_to_be_unique", {"column": "c_acctbal"}),
        ("column_values_to_be_unique", {"column": "c_custkey"}),
    )


@query(_all(
    _rule_sql(1, "column_values_to_be_in_set", "o_orderstatus", "orders",
              "o_orderstatus NOT IN ('F', 'O')"),
    _rule_sql(2, "column_values_to_be_in_set", "o_orderpriority", _HOLES,
              "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')", 0.5),
))
def dq_in_set(spark, folder):
    return _report(
        _with_holes(spark, folder),
        ("column_values_to_be_in_set", {"column": "o_orderstatus", "values": ["F", "O"]}),
        ("column_values_to_be_in_set",
         {"column": "o_orderpriority", "value_set": ["1-URGENT", "2-HIGH"], "mostly": 0.5}),
    )


@query(_all(
    _rule_sql(1, "column_values_to_not_be_in_set", "p_brand", "part",
              "p_brand IN ('Brand#2', 'Brand#17', 'Brand#99')"),
    _rule_sql(2, "column_values_to_not_be_in_set", "p_size", "part", "p_size IN (0, 51, 52)"),
))
def dq_not_in_set(spark, folder):
    return _report(
        read(spark, folder, "part"),
        ("column_values_to_not_be_in_set",
         {"column": "p_brand", "values": ["Brand#2", "Brand#17", "Brand#99"]}),
        ("column_values_to_not_be_in_set", {"column": "p_size", "values": [0, 51, 52]}),
    )


@query("""
SELECT * FROM (VALUES
  (1, 'expect_column_values_to_be_of_type', 'o_totalprice', true),
  (2, 'expect_column_values_to_be_of_type', 'o_custkey', false),
  (3, 'expect_table_column_count_to_equal', NULL, true)
) t(rule_seq, rule_type, column_name, success)
UNION ALL
SELECT 4, 'expect_table_row_count_to_be_between', NULL,
       (SELECT count(*) BETWEEN 10000 AND 1000000 FROM orders)
UNION ALL
SELECT 5, 'expect_column_null_count_to_be_between', 'o_orderpriority',
       (SELECT count(*) FILTER (o_orderpriority = '5-LOW') BETWEEN 1 AND 3000 FROM orders)
""")
def dq_table_rules(spark, folder):
    report = _report(
        _with_holes(spark, folder),
        ("column_values_to_be_of_type", {"column": "o_totalprice", "type": "DoubleType"}),
        ("column_values_to_be_of_type", {"column": "o_custkey", "type": "string"}),
        ("table_column_count_to_equal", {"value": 6}),
        ("table_row_count_to_be_between", {"min_value": 10000, "max_value": 1000000}),
        ("column_null_count_to_be_between",
         {"column": "o_orderpriority", "min_value": 1, "max_value": 3000}),
    )
    return report.select("rule_seq", "rule_type", "column_name", "success")


def _success(*parts) -> str:
    return _all(*[
        f"SELECT CAST({i} AS INTEGER) AS rule_seq, {column} AS column_name, {success} AS success"
        for i, (column, success) in enumerate(parts, 1)
    ])


@query(_success(
    ("CAST(NULL AS VARCHAR)", "(SELECT count(*) BETWEEN 1 AND 20000 FROM lineitem)"),
    ("CAST(NULL AS VARCHAR)", "(SELECT count(*) >= 20000 FROM lineitem)"),
))
def dq_row_count(spark, folder):
    report = _report(
        read(spark, folder, "lineitem"),
        ("table_row_count_to_be_between", {"min_value": 1, "max_value": 20000}),
        ("table_row_count_to_be_between", {"min_value": 20000}),
    )
    return report.select("rule_seq", "column_name", "success")


@query(_success(
    ("'o_orderpriority'", f"(SELECT count(*) BETWEEN 1 AND 3000 FROM {_HOLES} WHERE o_orderpriority IS NULL)"),
    ("'o_custkey'", "(SELECT count(*) = 0 FROM orders WHERE o_custkey IS NULL)"),
))
def dq_null_count(spark, folder):
    report = _report(
        _with_holes(spark, folder),
        ("column_null_count_to_be_between",
         {"column": "o_orderpriority", "min_value": 1, "max_value": 3000}),
        ("column_null_count_to_be_between", {"column": "o_custkey", "max_value": 0}),
    )
    return report.select("rule_seq", "column_name", "success")


_DATE_TEXT = """(SELECT *, CASE o_orderstatus
    WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 'O' THEN strftime(o_orderdate, '%m/%d/%Y')
    ELSE 'on ' || strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)"""


def _date_text(spark, folder):
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    return read(spark, folder, "orders").withColumn(
        "day",
        F.when(status == "F", F.date_format(date, "yyyy-MM-dd"))
        .when(status == "O", F.date_format(date, "MM/dd/yyyy"))
        .otherwise(F.concat(F.lit("on "), F.date_format(date, "yyyy-MM-dd"))),
    )


@query(_all(
    _rule_sql(1, "column_values_to_match_strftime_format", "day", _DATE_TEXT,
              "try_strptime(day, '%Y-%m-%d') IS NULL"),
    _rule_sql(2, "column_values_to_match_strftime_format", "day", _DATE_TEXT,
              "try_strptime(day, '%m/%d/%Y') IS NULL", 0.3),
))
def dq_strftime(spark, folder):
    return _report(
        _date_text(spark, folder),
        ("column_values_to_match_strftime_format", {"column": "day", "format": "%Y-%m-%d"}),
        ("column_values_to_match_strftime_format",
         {"column": "day", "format": "%m/%d/%Y", "mostly": 0.3}),
    )


@query(_rule_sql(1, "column_values_to_be_dateutil_parseable", "day", _DATE_TEXT,
                 "try_strptime(day, ['%Y-%m-%d', '%m/%d/%Y']) IS NULL"))
def dq_date_parseable(spark, folder):
    return _report(
        _date_text(spark, folder), ("column_values_to_be_dateutil_parseable", {"column": "day"})
    )


_PROPS = """(SELECT * REPLACE (CASE WHEN event_type = 'error'
    THEN left(props, length(props) - 1) ELSE props END AS props) FROM events)"""


def _props(spark, folder):
    cut = F.expr("left(props, char_length(props) - 1)")
    return read(spark, folder, "events").withColumn(
        "props", F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    )


@query(_rule_sql(1, "column_values_to_be_json_parseable", "props", _PROPS, "NOT json_valid(props)"))
def dq_json_parseable(spark, folder):
    return _report(
        _props(spark, folder), ("column_values_to_be_json_parseable", {"column": "props"})
    )


@query(_all(
    _rule_sql(1, "column_values_to_match_json_schema", "props", _PROPS,
              "NOT json_valid(props) OR CAST(json_extract_string(CASE WHEN json_valid(props) "
              "THEN props END, '$.k') AS INTEGER) NOT BETWEEN 10 AND 90"),
    _rule_sql(2, "column_values_to_match_json_schema", "props", _PROPS, "true"),
))
def dq_json_schema(spark, folder):
    number = {"type": "integer", "minimum": 10, "maximum": 90}
    return _report(
        _props(spark, folder),
        ("column_values_to_match_json_schema",
         {"column": "props",
          "schema": {"type": "object", "required": ["k"], "properties": {"k": number}}}),
        ("column_values_to_match_json_schema",
         {"column": "props", "schema": {"type": "object", "required": ["absent"]}}),
    )


_PREVIOUS = """(SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS prior,
    lag(ts) OVER (ORDER BY event_id) AS ts_prior,
    lag(value) OVER (ORDER BY event_id) AS any_prior FROM events)"""


@query(_all(
    _rule_sql(1, "column_values_to_be_increasing", "value", _PREVIOUS, "value < prior", 0.5),
    _rule_sql(2, "column_values_to_be_increasing", "event_id", _PREVIOUS, "ts < ts_prior"),
))
def dq_increasing(spark, folder):
    return _report(
        read(spark, folder, "events"),
        ("column_values_to_be_increasing",
         {"column": "value", "order_by": "event_id", "partition_by": "user_id", "mostly": 0.5}),
        ("column_values_to_be_increasing", {"column": "event_id", "order_by": "ts"}),
    )


@query(_all(
    _rule_sql(1, "column_values_to_be_decreasing", "value", _PREVIOUS, "value > prior"),
    _rule_sql(2, "column_values_to_be_decreasing", "value", _PREVIOUS, "value > any_prior", 0.4),
))
def dq_decreasing(spark, folder):
    return _report(
        read(spark, folder, "events"),
        ("column_values_to_be_decreasing",
         {"column": "value", "order_by": ["event_id"], "partition_by": ["user_id"]}),
        ("column_values_to_be_decreasing",
         {"column": "value", "order_by": "event_id", "mostly": 0.4}),
    )


_EVENT_DAY = "(SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)"


@query(_rule_sql(1, "column_values_to_be_within_last_n_days", "day", _EVENT_DAY,
                 "CAST(day AS DATE) < DATE '2024-01-25' - 20 OR CAST(day AS DATE) > DATE '2024-01-25'",
                 0.5))
def dq_last_n_days(spark, folder):
    events = read(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return _report(
        events,
        ("column_values_to_be_within_last_n_days",
         {"column": "day", "n": 20, "as_of": "2024-01-25", "mostly": 0.5}),
    )


_ORDER_DAY = "(SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"


@query(_rule_sql(1, "column_values_to_be_in_past", "day", _ORDER_DAY,
                 "o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'", 0.8))
def dq_in_past(spark, folder):
    orders = read(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _report(
        orders,
        ("column_values_to_be_in_past", {"column": "day", "as_of": "2001-01-01", "mostly": 0.8}),
    )


@query(_rule_sql(1, "column_values_to_be_greater_than_or_equal_to", "p_retailprice", "part",
                 "p_retailprice < 950"))
def dq_min(spark, folder):
    return _report(
        read(spark, folder, "part"),
        ("column_values_to_be_greater_than_or_equal_to",
         {"column": "p_retailprice", "min_value": 950}),
    )


@query(_all(
    _rule_sql(1, "column_value_lengths_to_be_between", "p_name", "part",
              "length(p_name) NOT BETWEEN 8 AND 10"),
    _rule_sql(2, "column_value_lengths_to_be_between", "p_brand", "part", "length(p_brand) < 8", 0.6),
))
def dq_length(spark, folder):
    return _report(
        read(spark, folder, "part"),
        ("column_value_lengths_to_be_between", {"column": "p_name", "min_value": 8, "max_value": 10}),
        ("column_value_lengths_to_be_between", {"column": "p_brand", "min_value": 8, "mostly": 0.6}),
    )


def _order_rules():
    return make_rules([
        ("expect_column_values_to_be_between",
         {"column": "o_totalprice", "min": 5000, "max": 450000}, "reject"),
        ("expect_column_values_to_be_in_set",
         {"column": "o_orderstatus", "values": ["F", "O"]}, "reject"),
        ("expect_column_values_to_be_increasing",
         {"column": "o_totalprice", "order_by": ["o_orderdate", "o_orderkey"],
          "partition_by": "o_custkey"}, "reject"),
        ("expect_column_values_to_be_between", {"column": "o_custkey", "max": 3}, "log"),
        ("expect_table_column_count_to_equal", {"value": 99}, "reject"),
    ])


_REJECTS = """(SELECT *, o_totalprice < 5000 OR o_totalprice > 450000 AS bad1,
    o_orderstatus NOT IN ('F', 'O') AS bad2,
    coalesce(o_totalprice < lag(o_totalprice) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), false) AS bad3 FROM orders)"""


@query(f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {_REJECTS}
WHERE NOT (bad1 OR bad2 OR bad3)""")
def dq_reject(spark, folder):
    cleaned, _ = act(read(spark, folder, "orders"), _order_rules())
    return cleaned.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(f"""SELECT o_orderkey, concat_ws(',', CASE WHEN bad1 THEN '1' END, CASE WHEN bad2 THEN '2' END,
    CASE WHEN bad3 THEN '3' END) AS failed_rules FROM {_REJECTS} WHERE bad1 OR bad2 OR bad3""")
def dq_quarantine(spark, folder):
    _, quarantine = act(read(spark, folder, "orders"), _order_rules())
    failed = F.array_join(F.col("failed_rules").cast("array<string>"), ",")
    return quarantine.select("o_orderkey", failed.alias("failed_rules"))


@query(f"""SELECT c_custkey, CASE WHEN same > 1 THEN -1 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment
         ELSE 'DEFAULT_VALUE' END AS c_mktsegment FROM {_BALANCES}""")
def dq_transform(spark, folder):
    rules = make_rules([
        ("expect_column_values_to_be_unique", {"column": "c_acctbal", "default": -1.0}, "transform"),
        ("expect_column_values_to_be_in_set",
         {"column": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]}, "transform"),
    ])
    cleaned, _ = act(read(spark, folder, "customer"), rules)
    return cleaned.select("c_custkey", "c_acctbal", "c_mktsegment")


@query(_all(
    _rule_sql(1, "column_values_to_match_regex", "c_name", "customer",
              "NOT regexp_matches(c_name, '[13579]$')", action="reject"),
    _rule_sql(2, "column_values_to_be_between", "c_acctbal", "customer",
              "c_acctbal < 0 OR c_acctbal > 9000", 0.8),
    _rule_sql(4, "column_values_to_be_in_set", "c_mktsegment", "customer",
              "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", action="transform"),
))
def dq_report(spark, folder):
    rows = [
        (4, "BRI001", "column_values_to_be_in_set",
         {"column": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]}, "transform"),
        (1, "BRI001", "column_values_to_match_regex",
         {"column": "c_name", "regex": "[13579]$"}, "reject"),
        (2, "BRI001", "column_values_to_be_between",
         {"column": "c_acctbal", "min": 0, "max": 9000, "mostly": 0.8}, "log"),
        (3, "BRI002", "column_values_to_be_unique", {"column": "c_name"}, "log"),
    ]
    rules = spark.createDataFrame(
        [(i, bri, "expect_" + kind, json.dumps(p), a, "GROUP1") for i, bri, kind, p, a in rows],
        "id INT, bri STRING, rule_type STRING, rule_parameters STRING, action STRING, drq_group STRING",
    )
    _, _, report = run_rules(read(spark, folder, "customer"), rules, "BRI001")
    return _flat(report)
