import csv
import glob
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lakewarden.functions.patterns import PATTERNS
from lakewarden.operators import activity, reshape, tagging


def test_cells_and_dictionary(spark):
    df = spark.createDataFrame([(2, "b", None), (1, None, [1])], "n INT, s STRING, a ARRAY<INT>")
    cells = sorted((r.id, r["values"]) for r in reshape.unpivot_cells(df).collect())
    assert cells == [(0, "1"), (0, "2"), (1, "b"), (2, "[1]")]
    head = reshape.unpivot_cells(df, 1, ["n"]).collect()
    assert sorted((r.id, r["values"]) for r in head) == [(0, "1"), (2, "[1]")]
    names = [(r.id, r.columnname) for r in reshape.column_dictionary(df).collect()]
    assert names == [(0, "n"), (1, "s"), (2, "a")]


def test_rebuild_tables(spark):
    rows = [
        ("db", "t", "{'a': 1, 'b': None, 'c': 'None is True'}"),
        ("db", "t", "{'a': 'it\\'s', \"d\": \"False\", 'e': False}"),
        ("db", "t", "__import__('os').getcwd()"),
        ("db", "u", "{'x': [1, None], 'y': {'z': True}}"),
        (None, "u", "{'x': 1}"),
        ("db", "t", None),
    ]
    df = spark.createDataFrame(rows, "dbname STRING, tablename STRING, rawdata STRING")
    records, bad = reshape.parse_records(df, ["dbname", "tablename"], "rawdata")
    assert bad.count() == 3
    got = sorted((r.filename, sorted(r.record.items())) for r in records.collect())
    assert got == [
        ("db.t", [("a", "1"), ("b", None), ("c", "None is True")]),
        ("db.t", [("a", "it's"), ("d", "False"), ("e", "false")]),
        ("db.u", [("x", "[1,null]"), ("y", '{"z":true}')]),
    ]
    folder = tempfile.mkdtemp(prefix="run-")
    tables, left = reshape.rebuild_tables(df, ["dbname", "tablename"], "rawdata", folder)
    assert sorted(map(tuple, tables.collect())) == [("db.t", list("abcde"), 2), ("db.u", ["x", "y"], 1)]
    assert left.count() == 3
    lines = []
    for f in glob.glob(folder + "/filename=db.t/*.txt"):
        lines += list(csv.reader(open(f)))
    assert ["a", "b", "c", "d", "e"] in lines and len([x for x in lines if x[0] != "a"]) == 2


def jobs_of(spark, fn):
    tracker, group = spark.sparkContext.statusTracker(), f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    out = fn()
    spark.sparkContext.setJobGroup("tests", "tests")
    return len(tracker.getJobIdsForGroup(group)), out


def test_tables_are_written_by_one_job_each_file_with_its_header(spark):
    rnd = random.Random(1)
    texts = ["plain", "with, comma", 'a "quote"', "line\nend", " blank ", "back\\slash", "", None, "é", "#", "'"]

    def records(n_tables, n):
        rows = []
        for i in range(n):
            t = 0 if i % 2 else rnd.randrange(n_tables)
            keys = [f"k{j}" for j in range(1 + t % 3)] + (["the, \"odd\" key"] if t == 2 else [])
            rows.append((f"db.t{t}", {k: rnd.choice(texts) for k in keys if rnd.random() < 0.9}))
        return rows, spark.createDataFrame(rows, "filename STRING, record MAP<STRING,STRING>")

    jobs = []
    for n_tables in (3, 25):
        rows, df = records(n_tables, 600)
        folder = tempfile.mkdtemp(prefix="run-")
        n, tables = jobs_of(spark, lambda: reshape.write_tables(df, folder, rows_per_file=50))
        jobs.append(n)
        for t in tables.collect():
            own = [r for name, r in rows if name == t.filename]
            assert t.n_rows == len(own)
            back = spark.read.option("header", True).option("multiLine", True).csv(f"{folder}/filename={t.filename}")
            assert back.columns == t["columns"]
            # The CSV writer and reader of Spark take an empty text for none and cut blanks at the ends.
            trim = lambda v: (v or "").strip(" ") or None
            want = sorted((tuple(trim(r.get(c)) for c in t["columns"]) for r in own), key=str)
            assert sorted((tuple(map(trim, r)) for r in back.collect()), key=str) == want
        files = glob.glob(f"{folder}/filename=db.t0/*.txt")
        assert len(files) > 1 and all(open(f).readline() == "k0\n" for f in files)
    assert abs(jobs[0] - jobs[1]) <= 1


def test_keys_that_are_data_are_an_error(spark):
    df = spark.range(50).select(F.lit("t").alias("filename"), F.create_map(F.concat(F.lit("k"), "id"), F.lit("v")).alias("record"))
    with pytest.raises(ValueError, match="records of t have 50 different keys"):
        reshape.write_tables(df, tempfile.mkdtemp(prefix="run-"), max_columns=40)
    acts = spark.range(50).select(F.lit("a").alias("activity"), F.format_string('{"k%d": 1}', "id").alias("activity_out"))
    with pytest.raises(ValueError, match="50 pairs"):
        activity.activity_fields(acts, max_fields=40)


def test_each_record_is_parsed_once(spark):
    fields = {"A": [f"a{i}" for i in range(12)], "B": [f"b{i}" for i in range(9)], "C": []}
    df = spark.createDataFrame([("w", "A", "s", "t", "p", "{}")], "workflow_id STRING, activity STRING, "
                               "activity_status STRING, activity_completion_time STRING, activity_parent STRING, activity_out STRING")
    plan = activity.flatten(df, fields)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json(") + plan.lower().count("jsontostructs(") == 2


GAZETTEER = [("Peru", "country"), ("PERU", "place"), ("Lima", "place"), ("Lima", "region"),
             ("Cusco", "place"), ("New York", "place"), ("c++", "skill"), ("++", "sign")]


@pytest.fixture(scope="module")
def gazetteer(spark):
    return spark.createDataFrame(GAZETTEER, "term STRING, label STRING")


@pytest.mark.parametrize("limits", [{}, {"max_broadcast_rows": 1, "rows_per_group": 3}])
def test_tag_values(spark, gazetteer, limits):
    values = ["peru", " PERU ", "Lima", "cusco", "cusco", "cusco", "cusco", "x", None, None, None, None]
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v STRING")
    tagged = tagging.tag_values(df, "v", gazetteer, {"is_country": "country", "is_region": "region"}, **limits)
    got = {r.id: (r.is_country, r.is_region) for r in tagged.collect()}
    assert got == {i: ((v or "").strip().lower() == "peru", v == "Lima") for i, v in enumerate(values)}
    cities = tagging.tag_cities(df, "v", gazetteer, **limits)
    assert cities.columns == ["id", "v", "is_city"]
    assert {r.id for r in cities.collect() if r.is_city} == {3, 4, 5, 6}


def test_tag_columns(spark, gazetteer):
    df = spark.createDataFrame(
        [("peru", "a@b.org", 1), ("Lima", None, 2), ("x", "c", 3), (None, None, 4)],
        "place STRING, mail STRING, n INT")
    email = [p for p in PATTERNS if p.name == "email"]
    got = {(r.columnname, r.tag): (r.n_values, r.n_hits) for r in
           tagging.tag_columns(df, gazetteer, email, 0.5).collect()}
    assert got == {("place", "place"): (3, 2), ("mail", "email"): (2, 1)}


@pytest.mark.parametrize("few", [200, 2])
def test_annotate_spans(spark, gazetteer, few):
    texts = ["in Lima, Lima and NewLima; New York!", "", None, "c++ Peru", "nothing", "Lima Limas"]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    out = tagging.annotate_spans(df, "id", "t", gazetteer, few_terms=few, rows_per_group=2,
                                 max_broadcast_rows=1 if few == 2 else 100)
    got = {r.id: None if r.entities is None else [(e.begin, e.end, e.label) for e in r.entities]
           for r in out.collect()}
    assert got == {
        0: [(3, 7, "place"), (3, 7, "region"), (9, 13, "place"), (9, 13, "region"), (27, 35, "place")],
        1: [], 2: None, 3: [(0, 3, "skill"), (4, 8, "country")], 4: [],
        5: [(0, 4, "place"), (0, 4, "region")],
    }


def test_annotate_terms(spark, gazetteer):
    got = {(r.content, tuple(map(tuple, r.entities))) for r in tagging.annotate_terms(gazetteer).collect()}
    assert ("Cusco", ((0, 5, "place"),)) in got and len(got) == len(GAZETTEER)
    empty = spark.createDataFrame([("", "x")], "term STRING, label STRING")
    assert tagging.annotate_terms(empty).first().entities == []


ROWS = [
    ("w1", "Start", "ok", "2024-01-02", None, '{"a": 1, "b": {"c": 2}}'),
    ("w1", "START", "late", "2024-01-03", "p", '{"a": 9}'),
    ("w1", "begin", "early", "2024-01-01", "q", '{"z": null}'),
    ("w1", "End", "ok", None, None, "broken {"),
    ("w2", "End", "x", "2024-01-05", None, '{"e": [1, 2]}'),
    ("w2", "End", "y", "2024-01-05", "r", None),
    ("w3", "Wait", "z", "2024-01-05", "r", None),
]


@pytest.mark.parametrize("limits", [{}, {"max_broadcast_rows": 0, "rows_per_group": 2}])
def test_flatten_workflow(spark, limits):
    df = spark.createDataFrame(
        ROWS, "workflow_id STRING, activity STRING, activity_status STRING, "
        "activity_completion_time STRING, activity_parent STRING, activity_out STRING")
    mapping = spark.createDataFrame(
        [("START", "Start"), ("Begin", "Start"), ("begin", "Zzz"), ("none", "x")],
        "input_value STRING, standardized_value STRING")
    clean = activity.standardize(df, mapping, "activity", **limits)
    assert clean.columns == df.columns and clean.count() == len(ROWS)
    assert {r.activity for r in clean.collect()} == {"Start", "End", "Wait"}
    fields = activity.activity_fields(clean)
    assert fields == {"End": ["e"], "Start": ["a", "b", "z"], "Wait": []}
    flat = activity.flatten(clean, fields, tiebreak=["activity_status"])
    assert flat.columns == ["workflow_id"] + [
        f"{a}_{c}" for a in ("End", "Start", "Wait")
        for c in ("status", "completion_time", "parent", "a", "b", "e", "z")]
    got = {r.workflow_id: r for r in flat.collect()}
    w1, w2 = got["w1"], got["w2"]
    assert (w1.Start_status, w1.Start_parent, w1.Start_a, w1.Start_z) == ("early", "q", None, None)
    assert (w1.End_status, w1.End_e, w1.Wait_status) == ("ok", None, None)
    assert (w2.End_status, w2.End_parent, w2.End_e) == ("x", None, "[1,2]")
    assert got["w3"].Wait_status == "z"
    own = activity.flatten(clean, fields, tiebreak=["activity_status"], every_field=False)
    assert "End_a" not in own.columns and "Start_a" in own.columns
    plan = activity.flatten(df, fields)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_nested_json_stays_text(spark):
    df = spark.createDataFrame([("w", "A", "s", "t", None, '{"b": {"c": 2}, "a": "x"}')],
                               "workflow_id STRING, activity STRING, activity_status STRING, "
                               "activity_completion_time STRING, activity_parent STRING, activity_out STRING")
    row = activity.flatten(df, activity.activity_fields(df)).first()
    assert (row.A_b, row.A_a) == ('{"c":2}', "x")
    assert df.select(F.json_object_keys("activity_out")).first()[0] == ["b", "a"]
