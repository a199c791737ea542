import json

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.quality import act, evaluate, flag_rows, run_rules
from lakewarden.operators.rules import make_rules

# (label, weight in grams, day of dispatch) of parcels: the second label lacks its check letter, the third is too light
# and was sent long ago.
PARCELS = [
    ("PX-1001-K", 540, "2022-03-04"),
    ("PX-1002", 1250, "2022-03-09"),
    ("PX-1003-M", 4, "2021-11-30"),
    ("PX-1004-A", 880, "2022-03-11"),
]


def by_seq(df):
    return {r.rule_seq: r for r in df.collect()}


def one(df, kind, **params):
    rule = make_rules([("expect_" + kind, params, "log")])
    return evaluate(df, rule).collect()[0]


@pytest.fixture(scope="module")
def parcels(spark):
    return spark.createDataFrame(PARCELS, "label STRING, weight BIGINT, sent STRING")


@pytest.fixture(scope="module")
def mixed(spark):
    data = [
        (1, "a", 1.0, '{"k": 1, "s": "x"}', "2024-01-05", None),
        (2, "b", 2.0, '{"k": "no"}', "2024-13-05", True),
        (3, "a", None, "oops", "05/01/2024", None),
        (4, None, 2.0, None, None, False),
        (5, "c", 9.0, '{"s": 5, "k": 2.0}', "yesterday", None),
    ]
    return spark.createDataFrame(
        data, "id INT, s STRING, x DOUBLE, j STRING, d STRING, b BOOLEAN"
    )


def test_example_run(spark, parcels):
    rules = spark.createDataFrame(
        [
            (1, "inbound", "expect_column_values_to_be_between", '{"column": "weight", "min": 5}', "log"),
            (2, "inbound", "expect_column_values_to_match_regex",
             '{"column": "label", "regex": "^PX-[0-9]{4}-[A-Z]$"}', "reject"),
            (3, "inbound", "expect_table_column_count_to_equal", '{"value": 3}', "log"),
            (4, "inbound", "no_such_rule", "{}", "reject"),
            (5, "inbound", "expect_column_values_to_be_within_last_n_days",
             '{"column": "sent", "n": 60, "as_of": "2022-03-15"}', "reject"),
            (6, "inbound", "expect_column_values_to_not_be_null", "not json", "reject"),
            (7, "inbound", "expect_table_row_count_to_be_between", '{"max_value": 10}', "log"),
            (8, "outbound", "expect_table_column_count_to_equal", '{"value": 9}', "log"),
        ],
        "id INT, bri STRING, rule_type STRING, rule_parameters STRING, action STRING",
    )
    cleaned, quarantine, report = run_rules(parcels, rules, "inbound")
    got = by_seq(report)
    assert {n: r.success for n, r in got.items()} == {
        1: False, 2: False, 3: True, 4: False, 5: False, 6: False, 7: True}
    assert got[1].unexpected_count == 1 and got[1].partial_unexpected == ["4"]
    assert got[2].partial_unexpected == ["PX-1002"]
    assert "Unsupported rule type" in got[4].exception and got[6].exception
    assert sorted(r.label for r in cleaned.collect()) == ["PX-1001-K", "PX-1004-A"]
    assert sorted((r.label, r.failed_rules) for r in quarantine.collect()) == [("PX-1002", [2]), ("PX-1003-M", [5])]


def test_value_rules(mixed):
    r = one(mixed, "column_values_to_be_between", column="x", min_value=1, max_value=2)
    assert (r.element_count, r.missing_count, r.unexpected_count, r.success) == (5, 1, 1, False)
    assert r.unexpected_fraction == 0.25 and r.partial_unexpected == ["9.0"]
    assert one(mixed, "column_values_to_be_between", column="x", min=1, max=2, mostly=0.75).success
    assert not one(mixed, "column_values_to_be_between", column="x", max=2, mostly=0.76).success
    assert one(mixed, "column_values_to_be_between", column="x", min=1).success
    strict = one(mixed, "column_values_to_be_between", column="x", min=1, max=9, strict_bounds=True)
    assert strict.unexpected_count == 2
    assert one(mixed, "column_values_to_be_between", column="s", min=1).exception
    assert one(mixed, "column_values_to_be_between", column="nope", min=1).exception
    assert one(mixed, "column_values_to_be_between", column="x").exception
    r = one(mixed, "column_values_to_be_in_set", column="s", values=["a", "b"])
    assert (r.unexpected_count, r.partial_unexpected) == (1, ["c"])
    assert one(mixed, "column_values_to_be_in_set", column="id", value_set=[1, 2, 3, 4, 5]).success
    assert one(mixed, "column_values_to_not_be_in_set", column="s", values=["c", None]).unexpected_count == 1
    r = one(mixed, "column_values_to_not_be_null", column="b", mostly=0.4)
    assert (r.unexpected_count, r.success, r.unexpected_fraction) == (3, True, 0.6)
    assert one(mixed, "column_values_to_match_regex", column="s", regex="[ab]").unexpected_count == 1
    assert one(mixed, "column_values_to_match_regex", column="s", regex="(").exception
    assert one(mixed, "column_value_lengths_to_be_between", column="d", min_value=10).unexpected_count == 1
    assert one(mixed, "column_values_to_be_greater_than_or_equal_to", column="x", min_value=2).unexpected_count == 1


def test_text_rules(mixed):
    r = one(mixed, "column_values_to_match_strftime_format", column="d", format="%Y-%m-%d")
    assert r.partial_unexpected == ["05/01/2024", "2024-13-05", "yesterday"]
    assert one(mixed, "column_values_to_match_strftime_format", column="d", format="%Q").exception
    r = one(mixed, "column_values_to_be_dateutil_parseable", column="d")
    assert r.partial_unexpected == ["2024-13-05", "yesterday"]
    r = one(mixed, "column_values_to_be_json_parseable", column="j")
    assert (r.partial_unexpected, r.missing_count) == (["oops"], 1)
    schema = {
        "type": "object",
        "required": ["k"],
        "properties": {"k": {"type": "integer", "minimum": 1}, "s": {"enum": ["x", "y"]}},
    }
    r = one(mixed, "column_values_to_match_json_schema", column="j", schema=schema)
    assert r.partial_unexpected == ['oops', '{"k": "no"}', '{"s": 5, "k": 2.0}']
    assert one(mixed, "column_values_to_match_json_schema", column="j",
               schema={"pattern": "x"}).exception


def test_strftime_shapes(spark):
    cases = [
        ("%d/%m/%Y %H:%M:%S", "5/1/2024 3:04:05", True),
        ("%d/%m/%Y %H:%M:%S", "5/1/2024 25:04:05", False),
        ("%Y%m%d", "20240229", True),
        ("%Y%m%d", "20230229", False),
        ("%d %b %Y", "05 Jan 2024", True),
        ("%B %d, %y", "January 5, 24", True),
        ("%Y-%j", "2024-366", True),
        ("%I:%M %p", "11:30 PM", True),
        ("%H:%M:%S.%f", "01:02:03.5", True),
        ("%Y-%m-%dT%H", "2024-01-05T07", True),
        ("%Y-%m-%d", "2024-01-05 ", False),
        ("100%% %Y", "100% 2024", True),
    ]
    for fmt, text, ok in cases:
        df = spark.createDataFrame([(text,)], "t STRING")
        r = one(df, "column_values_to_match_strftime_format", column="t", format=fmt)
        assert (r.success, r.exception) == (ok, None), (fmt, text)


def test_table_and_type_rules(mixed):
    assert one(mixed, "table_row_count_to_be_between", min_value=5, max_value=5).success
    assert not one(mixed, "table_row_count_to_be_between", min_value=6).success
    assert one(mixed, "column_null_count_to_be_between", column="b", min_value=3, max_value=3).success
    assert not one(mixed, "column_null_count_to_be_between", column="b", max_value=2).success
    for name in ("string", "StringType", "STRING"):
        assert one(mixed, "column_values_to_be_of_type", column="s", type=name).success
    assert not one(mixed, "column_values_to_be_of_type", column="id", type_="LongType").success


def test_time_rules(mixed, spark):
    df = mixed.withColumn("t", F.col("d").try_cast("timestamp_ntz"))
    assert one(df, "column_values_to_be_in_past", column="t", as_of="2024-01-06").success
    assert not one(df, "column_values_to_be_in_past", column="t", as_of="2024-01-05").success
    assert one(df, "column_values_to_be_in_past", column="t").success
    r = one(df, "column_values_to_be_within_last_n_days", column="d", n=5, as_of="2024-01-10")
    assert r.unexpected_count == 3
    assert one(df, "column_values_to_be_within_last_n_days", column="t", n=4,
               as_of="2024-01-10").unexpected_count == 1


def test_unique_and_order(mixed, spark):
    r = one(mixed, "column_values_to_be_unique", column="s")
    assert (r.unexpected_count, r.missing_count, r.partial_unexpected) == (2, 1, ["a"])
    r = one(mixed, "column_values_to_be_increasing", column="x", order_by="id")
    assert r.success
    r = one(mixed, "column_values_to_be_decreasing", column="x", order_by=["id"])
    assert (r.unexpected_count, r.partial_unexpected) == (2, ["2.0", "9.0"])
    r = one(mixed, "column_values_to_be_decreasing", column="x", order_by="id", partition_by="s")
    assert r.success
    assert one(mixed, "column_values_to_be_increasing", column="x").exception


@pytest.mark.parametrize("limit", [40, 10_000])
def test_split_groups_give_the_same_rows(spark, limit):
    df = spark.range(600).select(
        "id", F.expr("if(id % 3 = 0, 'x', concat('v', id % 150))").alias("s"),
        F.expr("(id * 37) % 101").alias("v"),
    )
    rules = make_rules([
        ("expect_column_values_to_be_unique", {"column": "s"}, "reject"),
        ("expect_column_values_to_be_increasing", {"column": "v", "order_by": "id"}, "reject"),
        ("expect_column_values_to_be_decreasing",
         {"column": "v", "order_by": "id", "partition_by": "s"}, "reject"),
    ])
    got = {r.id: r.failed_rules for r in flag_rows(df, rules, limit, 20).collect()}
    data = [(r.id, r.s, r.v) for r in df.orderBy("id").collect()]
    last, last_of, want = None, {}, {}
    for i, s, v in data:
        failed = [1] if sum(x[1] == s for x in data) > 1 else []
        failed += [2] if last is not None and v < last else []
        failed += [3] if s in last_of and v > last_of[s] else []
        last, last_of[s], want[i] = v, v, failed
    assert got == want
    report = by_seq(evaluate(df, rules, rows_per_group=limit))
    for seq in (1, 2, 3):
        assert report[seq].unexpected_count == sum(seq in f for f in want.values())


def test_transform(mixed):
    rules = make_rules([
        ("expect_column_values_to_be_in_set", {"column": "s", "values": ["a", "b"]}, "transform"),
        ("expect_column_values_to_be_between", {"column": "x", "max": 5, "default": 0}, "transform"),
        ("expect_column_values_to_be_between", {"column": "id", "max": 4}, "transform"),
        ("expect_column_values_to_be_json_parseable", {"column": "j"}, "reject"),
        ("expect_table_column_count_to_equal", {"value": 1}, "reject"),
    ])
    cleaned, quarantine = act(mixed, rules)
    assert cleaned.schema == mixed.schema or cleaned.columns == mixed.columns
    rows = {r.d: (r.id, r.s, r.x) for r in cleaned.collect()}
    assert rows["yesterday"] == (None, "DEFAULT_VALUE", 0.0)
    assert rows[None] == (4, None, 2.0)
    assert [r.id for r in quarantine.collect()] == [3]


def test_row_rules_share_one_scan(mixed):
    rules = make_rules([
        ("expect_column_values_to_be_between", {"column": "x", "min": 1}, "log"),
        ("expect_column_values_to_not_be_null", {"column": "s"}, "log"),
        ("expect_column_values_to_be_in_set", {"column": "s", "values": ["a"]}, "log"),
    ])
    plan = evaluate(mixed, rules, examples=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    assert json.dumps(rules[0].params)
