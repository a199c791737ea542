import json
import statistics

import pytest

from lakewarden.operators.profiling import distinct_counts, few_values, profile, value_histogram
from lakewarden.operators.quality import evaluate
from lakewarden.operators.suggest import as_rules, dbt_view, ge_view, suggest_rules
from examples import transactions


def test_profile_of_all_types(spark):
    data = [
        (1, 1.5, "aa", True, None), (2, float("nan"), None, None, None),
        (None, -2.0, "b", False, None), (4, None, "éèê", True, None),
    ]
    df = spark.createDataFrame(data, "id INT, x DOUBLE, s STRING, b BOOLEAN, v DATE")
    got = {r.column_name: r for r in profile(df).collect()}
    assert [got[c].data_type for c in df.columns] == [
        "Integral", "Fractional", "String", "Boolean", "Date"]
    assert (got["id"].minimum, got["id"].maximum, got["id"].completeness) == (1.0, 4.0, 0.75)
    assert abs(got["id"].std_dev - statistics.pstdev([1, 2, 4])) < 1e-12
    assert (got["x"].minimum, got["x"].maximum, got["x"].mean) == (-2.0, 1.5, -0.25)
    assert (got["s"].min_length, got["s"].max_length) == (1, 3)
    assert got["v"].completeness == 0.0 and got["v"].first_time is None
    counts = {r.column_name: r.n_distinct for r in distinct_counts(df).collect()}
    assert counts == {"id": 4, "x": 4, "s": 4, "b": 3, "v": 1}
    assert profile(df.limit(0)).count() == 5


def test_approximate_counts_are_close(table):
    orders = table("orders")
    exact = {r.column_name: r.n_distinct for r in distinct_counts(orders).collect()}
    close = {r.column_name: r.n_distinct for r in distinct_counts(orders, approximate=True).collect()}
    for name, n in exact.items():
        assert abs(close[name] - n) <= 0.05 * n + 1


def test_histogram(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "p STRING, q STRING")
    got = {(r.column_name, r.value): r.n for r in value_histogram(df, ["p", "q"]).collect()}
    assert got == {("p", "a"): 2, ("p", "b"): 1, ("q", "x"): 2}


def test_transactions_suggestions_can_all_be_evaluated(spark):
    df = transactions(spark, 2000, seed=3).cache()
    rules = suggest_rules(df, "transactions")
    rows = rules.orderBy("rule_seq").collect()
    assert [(r.column_name, r.dbt_rule_name) for r in rows] == [
        ("id", "not_null"), ("id", "relationships.range"), ("id", "expression_is_true"),
        ("till", "not_null"), ("till", "relationships.range"),
        ("till", "expression_is_true"),
        ("total", "not_null"), ("total", "relationships.range"), ("total", "expression_is_true"),
        ("paid_by", "not_null"), ("paid_by", "expression_is_true"), ("paid_by", "accepted_values"),
        ("day", "not_null"), ("day", "expression_is_true"),
        ("day", "expression_is_true"),
        ("returned", "not_null"), ("ALL_COLUMNS", "row_count"), ("id", "unique"),
    ]
    assert json.loads(rows[1].parameters) == {
        "column": "id", "min": 0, "max": 1999, "strict_bounds": False, "mostly": 0.95}
    assert rows[1].description == "Values in id should be between 0.00 and 1999.00"
    assert rows[11].value_set == ["card", "cash", "voucher"]
    assert json.loads(rows[16].parameters) == {"min_value": 1600.0, "max_value": 2400.0}
    assert {r.mostly for r in rows if r.dbt_rule_name == "not_null"} == {0.95}
    report = evaluate(df, as_rules(rules)).collect()
    assert all(r.exception is None for r in report)
    failed = {(r.rule_type, r.column_name) for r in report if not r.success}
    assert failed <= {("expect_column_values_to_be_in_past", "day")}
    assert dbt_view(rules).columns[2] == "dbt_rule_name" and ge_view(rules).columns[2] == "ge_rule_name"


def test_sampling_keeps_the_full_row_count(spark):
    df = transactions(spark, 5000, seed=1)
    rows = suggest_rules(df, "t", sample_size=500).filter("dbt_rule_name = 'row_count'").collect()
    assert json.loads(rows[0].parameters) == {"min_value": 4000.0, "max_value": 6000.0}
    empty = suggest_rules(df.limit(0), "t").collect()
    assert [r.dbt_rule_name for r in empty].count("not_null") == 6


@pytest.mark.parametrize("n", [0, 1, 18, 19, 20, 21, 29, 47, 60, 3000])
def test_few_values_are_exact(spark, n):
    """Around the limit, with and without NULL, whatever the number of rows per value."""
    rows = [(f"v{i % n}", None if i % 5 == 0 else f"v{i % n}") for i in range(5000)] if n else [(None, None)] * 3
    df = spark.createDataFrame(rows, "`plain` STRING, `with``null` STRING").repartition(5)
    for name, at in (("plain", 0), ("with`null", 1)):
        want = {r[at] for r in rows}
        got = df.agg(few_values(name, 19)).first()[0]
        assert (set(got) == want and len(got) == len(want)) if len(want) <= 19 else got is None


def test_suggestions_take_one_scan(spark, table):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("suggest", "suggest")
    suggest_rules(table("orders"), "orders")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert len(tracker.getJobIdsForGroup("suggest")) <= 3
