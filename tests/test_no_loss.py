"""Nothing is left out or changed without a sign."""

import json
import os

import pytest

from lakewarden.operators import catalog, lineage, registry, reshape
from lakewarden.operators.quality import act, evaluate, run_rules
from lakewarden.operators.rules import make_rules
from lakewarden.operators.tagging import annotate_spans
from lakewarden.streaming import registry_stream


@pytest.fixture(scope="module")
def chain(spark):
    rows = [(i, f"n{i}", f"n{i + 1}", "copy", 1) for i in range(110)]
    schema = "id BIGINT, input_bri STRING, output_bri STRING, movement_type STRING, relationship_level INT"
    return spark.createDataFrame(rows, schema).coalesce(1).cache()


def test_long_chain_is_complete(chain):
    got = lineage.downstream(chain, "n0", distinct_edges=True)
    assert sorted(r.level for r in got.collect()) == list(range(110))


@pytest.mark.parametrize("distinct", [True, False])
def test_depth_limit_is_no_silent_cut(chain, distinct):
    cut = lineage.downstream(chain, "n0", max_depth=3, distinct_edges=distinct).collect()
    assert [(r.level, r.cut_off) for r in sorted(cut, key=lambda r: r.level)] == [(i, True) for i in range(3)]
    whole = lineage.downstream(chain, "n107", max_depth=3, distinct_edges=distinct).collect()
    assert len(whole) == 3 and not any(r.cut_off for r in whole)


def event(seq, action, bri, **meta):
    body = {"seq": seq, "action": action}
    body |= {"bri": bri} if action == "delete" else {"metadata": {"bri": bri, **meta}}
    return json.dumps(body), seq


def lines(spark, *events):
    return spark.createDataFrame(list(events), "value STRING, seq BIGINT")


def test_late_events_unknown_fields_and_buckets(spark, tmp_path):
    path = str(tmp_path / "registry")
    create = event(5, "create", "a", name="x", datatype="d", owner="me")
    registry_stream.apply_batch(lines(spark, create, event(6, "create", "b", name="y", datatype="d")), 0, path, 4)
    late, again = event(3, "update", "a", name="old"), event(5, "update", "a", name="same number")
    registry_stream.apply_batch(lines(spark, late, again, event(7, "update", "b", name="z")), 1, path, 4)
    changes = {(r.bri, r.seq): r.status for r in registry_stream.read_changes(spark, path).filter("batch = 1").collect()}
    # The late update came before its entity existed; the other one has the number of the create.
    assert changes == {("a", 3): "ignored_missing", ("a", 5): "rejected_same_seq", ("b", 7): "applied"}
    held = {r.bri: r.fields for r in registry_stream.read_registry(spark, path).collect()}
    assert held["a"]["owner"] == "me" and held["a"]["name"] == "x" and held["b"]["name"] == "z"
    with pytest.raises(ValueError, match="has 4 buckets"):
        registry_stream.apply_batch(lines(spark, event(9, "delete", "a")), 2, path, 8)


def test_text_behind_an_event_is_a_dead_letter(spark):
    good = event(1, "create", "a", name="x", datatype="d")[0]
    df = lines(spark, (good, 1), (good + " oops", 2), (good + good, 3), (good + "," + good, 4), ("", 5), (" " + good + " ", 6))
    events, dead = registry.parse_events(df)
    assert sorted(r.seq for r in events.collect()) == [1, 6]
    assert {(r.seq, r.reason) for r in dead.collect()} == {(n, "not an event") for n in (2, 3, 4, 5)}


def test_records_with_more_text_and_escapes(spark):
    texts = {
        1: "{'a': 1}", 2: "{'a': 1}{'b': 2}", 3: "{'a': 1} oops", 4: "{'a': 1}, {'b': 2}", 5: r"{'a': '\x41\\x41'}",
        6: r"{'a': '\q'}", 7: r"{'a': 'it\'s é', 'b': None}", 8: "{'a': 'x', }", 9: r"{'a': '\x4'}",
    }
    df = spark.createDataFrame([(k, "d", v) for k, v in texts.items()], "id INT, db STRING, raw STRING")
    good, bad = reshape.parse_records(df, ["db"], "raw")
    got = {r.id: r.record for r in good.collect()}
    assert got == {1: {"a": "1"}, 5: {"a": "A\\x41"}, 7: {"a": "it's é", "b": None}}
    assert {r.id for r in bad.collect()} == {2, 3, 4, 6, 8, 9}


def test_table_names_stay_in_their_folder(spark, tmp_path):
    df = spark.createDataFrame([("../up", "{'a': 1}"), ("x/y", "{'a': 2}"), ("..", "{'a': 3}")], "db STRING, raw STRING")
    records, _ = reshape.parse_records(df, ["db"], "raw")
    reshape.write_tables(records, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path)) == ["out"]
    assert sorted(x for x in os.listdir(tmp_path / "out") if not x.startswith(".")) == ["_SUCCESS", "filename=..", "filename=..%2Fup", "filename=x%2Fy"]


def test_a_bad_rule_does_not_stop_the_others(spark):
    df = spark.createDataFrame([(1, [1], "a", {"k": 1}), (2, [2], "b", {"k": 2})], "i INT, l ARRAY<INT>, s STRING, m MAP<STRING,INT>")
    rules = make_rules([
        ("expect_column_values_to_be_between", {"column": "i", "min_value": 2}, "log"),
        ("expect_column_values_to_be_between", {"column": "l", "min_value": 1}, "log"),
        ("expect_column_values_to_be_within_last_n_days", {"column": "i", "n": 3}, "log"),
        ("expect_table_row_count_to_be_between", {"min_value": "many"}, "log"),
        ("expect_column_values_to_be_unique", {"column": "m"}, "log"),
        ("expect_column_values_to_be_increasing", {"column": "m", "order_by": "i"}, "log"),
        ("expect_column_values_to_not_be_null", {"column": "s", "mostly": "all"}, "log"),
        ("expect_column_values_to_be_in_set", {"column": "i", "values": [2], "default": "none"}, "transform"),
        ("expect_column_values_to_be_in_set", {"column": "s", "values": ["a"], "default": "z"}, "transform"),
    ])
    report = {r.rule_seq: r for r in evaluate(df, rules).collect()}
    assert set(report) == set(range(1, 10))
    assert [n for n, r in report.items() if r.exception is None] == [1, 9] or {
        n for n, r in report.items() if r.exception is None} == {1, 9}
    assert report[1].unexpected_count == 1 and not any(report[n].success for n in range(2, 9))
    cleaned, quarantine = act(df, rules)
    assert sorted((r.i, r.s) for r in cleaned.collect()) == [(1, "a"), (2, "z")] and quarantine.count() == 0


def test_session_views_are_listed_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    spark.range(1).createOrReplaceTempView("passing")
    try:
        rows = catalog.catalog_metadata(spark).filter("table_name = 'passing'").collect()
        assert [(r.database_name, r.is_view) for r in rows] == [(None, "YES")]
    finally:
        spark.catalog.dropTempView("passing")
        spark.sql("DROP DATABASE other CASCADE")


def test_spans_of_texts_without_id(spark):
    texts = spark.createDataFrame([(None, "in Lima and Peru"), (1, "Lima")], "id INT, t STRING")
    terms = spark.createDataFrame([("Lima", "city"), ("Peru", "country")], "term STRING, label STRING")
    found = [
        sorted((r.content, len(r.entities)) for r in annotate_spans(texts, "id", "t", terms, few_terms=n).collect())
        for n in (0, 200)
    ]
    assert found[0] == found[1] == [("Lima", 1), ("in Lima and Peru", 2)]


def test_run_of_stored_rules_keeps_every_row(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "i INT, k INT")
    stored = spark.createDataFrame(
        [(1, "b", "expect_column_values_to_be_in_set", '{"column": "k", "values": [0, 1]}', "reject"),
         (2, "b", "expect_column_values_to_be_between", '{"column": "i", "max": "x"}', "reject")],
        "id INT, bri STRING, rule_type STRING, rule_parameters STRING, action STRING")
    cleaned, quarantine, report = run_rules(df, stored, "b")
    assert cleaned.count() == 20 and {tuple(r.failed_rules) for r in quarantine.collect()} == {(1,)}
    assert {r.rule_seq: r.exception is None for r in report.collect()} == {1: True, 2: False}
