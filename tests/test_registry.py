import random

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import lineage, registry

FIELDS = ["name", "datatype", "tag"]


def loop(events):
    """The same fold, one event after the other."""
    living, statuses, versions = {}, {}, {}
    for bri, seq, action, fields in sorted(events, key=lambda e: e[1]):
        if action == "create":
            status = "rejected_duplicate" if bri in living else "applied"
            if status == "applied":
                living[bri] = dict(fields)
        elif action in ("update", "delete"):
            status = "applied" if bri in living else "ignored_missing"
            if status == "applied" and action == "update":
                living[bri].update(fields)
            elif status == "applied":
                del living[bri]
        else:
            status = "ignored_action"
        if status == "applied":
            versions[seq] = versions.get(bri, 0) + 1
            versions[bri] = versions[seq]
        statuses[seq] = status
    return statuses, living, versions


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(11)
    out = []
    for seq in range(2500):
        bri = rnd.choice(["hot", "hot", "b", "c", f"k{rnd.randrange(40)}"])
        action = rnd.choices(["create", "update", "delete", "noop"], [3, 6, 2, 1])[0]
        fields = {f: rnd.choice([None, f"{f}{seq}"]) for f in FIELDS if rnd.random() < 0.4}
        out.append((bri, seq, action, fields))
    rnd.shuffle(out)
    return out


SCHEMA = "bri STRING, seq BIGINT, action STRING, fields MAP<STRING,STRING>"


@pytest.mark.parametrize("limit", [60, 10_000])
def test_fold_equals_a_loop(spark, events, limit):
    df = spark.createDataFrame(events, SCHEMA)
    statuses, living, versions = loop(events)
    folded = registry.fold_events(df, rows_per_group=limit)
    assert {r.seq: r.status for r in folded.collect()} == statuses
    now = registry.current(df, FIELDS, rows_per_group=limit).collect()
    assert {r.bri: r.fields for r in now} == living
    past = registry.history(df, rows_per_group=limit)
    assert "_block" not in past.columns
    assert {r.seq: r.version for r in past.collect()} == {
        k: v for k, v in versions.items() if isinstance(k, int)}


def test_parse_validate_and_type(spark):
    texts = [
        '{"action": "create", "metadata": {"bri": "a", "name": "A", "datatype": "int", '
        '"retention": 30, "tag": ["x", "y"], "additional_metadata": {"k": [1]}}}',
        '{"action": "update", "metadata": {"bri": "a", "businessTitle": null, "nullable": true}}',
        '{"action": "create", "metadata": {"bri": "b", "name": "B"}}',
        '{"action": "delete", "bri": "zz"}',
        '{"action": "delete"}', "nonsense", '{"action": "rename", "bri": "a"}',
        '{"action": "create", "metadata": "text"}',
        '{"action": "create", "metadata": {"bri": "c", "name": "C", "datatype": "d", "metadataclass": null}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "seq BIGINT, value STRING")
    events, dead = registry.parse_events(df)
    assert {r.seq: r.reason for r in dead.collect()} == {
        2: "missing: datatype", 4: "no bri", 5: "not an event", 6: "unknown action", 7: "no bri"}
    now = registry.current(events, list(registry.ENTITY_FIELDS))
    rows = {r.bri: r for r in registry.entities(now).collect()}
    a, c = rows["a"], rows["c"]
    assert (a.name, a.retention, a.tag, a.nullable, a.primaryKeyColumn) == ("A", 30, ["x", "y"], True, False)
    assert (a.metadatatype, a.businessTitle, c.metadataclass, c.retention) == ("Metadata", None, "relational", 365)
    assert a.additional_metadata.toPython() == {"k": [1]} and c.tag == []
    assert registry.find_entity(now, "a").count() == 1


def test_validate_and_defaults(spark):
    df = spark.createDataFrame(
        [("a", "int", "A", None), ("b", None, " ", 7)], "bri STRING, datatype STRING, name STRING, retention INT")
    good, bad = registry.validate(df)
    assert [r.reason for r in bad.collect()] == ["missing: datatype, name"]
    row = registry.fill_defaults(good).first()
    assert (row.retention, row.metadataclass, row.nullable, row.tag) == (365, "relational", False, [])


def test_children(spark):
    metadata = spark.createDataFrame([("a", "t"), ("b", "u"), ("c", "v")], "bri STRING, type STRING")
    columns = spark.createDataFrame(
        [(i, "a" if i < 7 else "b", f"n{i}", "d") for i in range(9)],
        "id INT, bri STRING, name STRING, data_type STRING")
    for limit in (3, 1000):
        nested = registry.with_columns(metadata, columns, 3, limit).collect()
        got = {(r.bri, r.part): [c.id for c in r["columns"]] for r in nested}
        assert got == {("a", 0): [0, 1, 2], ("a", 1): [3, 4, 5], ("a", 2): [6], ("b", 0): [7, 8], ("c", 0): []}
    updates = spark.createDataFrame(
        [(1, 1, "a", {"name": "x"}), (1, 2, "a", {"name": None}), (8, 3, "b", {"data_type": "z"}),
         (20, 4, "c", {"name": "new"}), (21, 5, "nope", {"name": "lost"})],
        "id INT, seq INT, bri STRING, fields MAP<STRING,STRING>")
    after = {r.id: tuple(r)[1:] for r in registry.upsert_columns(columns, updates, metadata).collect()}
    assert after[1] == ("a", None, "d") and after[8] == ("b", "n8", "z")
    assert after[20] == ("c", "new", None) and 21 not in after and len(after) == 10
    gone = spark.createDataFrame([("a",), (None,)], "bri STRING")
    for limits in ({}, {"max_broadcast_rows": 0, "rows_per_group": 3}):
        left, cols = registry.delete_cascade(metadata, columns, gone, **limits)
        assert {r.bri for r in left.collect()} == {"b", "c"} and {r.id for r in cols.collect()} == {7, 8}


EDGES = [(1, "a", "b"), (2, "a", "c"), (3, "b", "d"), (4, "c", "d"), (5, "d", "e"), (6, "e", "a"),
         (7, "e", "e"), (8, "x", "y"), (9, "d", "f")] + [(100 + i, "f", f"leaf{i}") for i in range(30)]


def walk(node, path, level=0):
    for i, a, b in EDGES:
        if a == node and b not in path:
            yield i, level, (*path, b)
            yield from walk(b, (*path, b), level + 1)


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(
        [(i, a, b, "copy", 1) for i, a, b in EDGES],
        "id INT, input_bri STRING, output_bri STRING, movement_type STRING, relationship_level INT")


@pytest.mark.parametrize("limits", [{}, {"rows_per_group": 5}, {"max_broadcast_rows": 0, "rows_per_group": 5}])
def test_downstream(edges, limits):
    got = sorted((r.id, r.level, tuple(r.path)) for r in lineage.downstream(edges, "a", **limits).collect())
    assert got == sorted(walk("a", ("a",)))
    once = lineage.downstream(edges, ["a"], distinct_edges=True, **limits).collect()
    levels = {r.id: r.level for r in once}
    assert len(once) == len(levels) == len(EDGES) - 1
    assert [levels[i] for i in (1, 2, 3, 4, 5, 6, 7, 9, 100)] == [0, 0, 1, 1, 2, 3, 3, 2, 3]
    short = lineage.downstream(edges, "a", max_depth=2, **limits)
    assert {r.id for r in short.collect()} == {1, 2, 3, 4}
    assert lineage.downstream(edges, "nobody", **limits).count() == 0


def test_edit_edges(spark, edges):
    new = spark.createDataFrame([("p", "q", "move", 2)], "input_bri STRING, output_bri STRING, "
                                "movement_type STRING, relationship_level INT")
    more = lineage.add_edges(edges, new)
    assert more.filter(F.col("input_bri") == "p").first().id == 130
    gone = spark.createDataFrame([(130,), (1,)], "id INT")
    assert lineage.delete_edges(more, gone).count() == len(EDGES) - 1


def test_edges_do_not_move_after_they_are_stored(spark):
    """At every level only the frontier is exchanged; the edges are read by bucket."""
    edges = spark.range(3000).select(
        "id", F.concat(F.lit("n"), F.col("id") % 700).alias("input_bri"), F.concat(F.lit("n"), F.col("id") % 911).alias("output_bri"),
        F.lit("copy").alias("movement_type"), F.lit(1).alias("relationship_level"))
    stored = lineage.StoredEdges(edges)
    frontier = spark.createDataFrame([("n1", ["n1"])], "input_bri STRING, path ARRAY<STRING>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = stored.leaving(frontier)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") > plan.index("Bucketed: true")
    left = {(r.input_bri, r.output_bri) for r in stored.leaving(frontier).collect()}
    assert left == {("n1", f"n{i % 911}") for i in range(1, 3000, 700)}
