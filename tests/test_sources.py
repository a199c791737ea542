import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import catalog, registry
from lakewarden.operators.suggest import suggest_rules
from examples import transactions
from lakewarden.sources import files, jdbc, streams, tables
from lakewarden.streaming import registry_stream


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def test_documents_and_broken_files(spark, folder):
    docs = {
        "a.json": '{"bri": "a", "name": "A",\n "datatype": "int", "tag": ["x"], "additional_metadata": {"k": 1}}',
        "b.json": '{"bri": "b", ',
        "c.json": '{"bri": "c", "datatype": "d"}',
    }
    for name, text in docs.items():
        open(f"{folder}/{name}", "w").write(text)
    good, broken = files.read_documents(spark, folder)
    assert [os.path.basename(r.file) for r in broken.collect()] == ["b.json"]
    valid, rejected = registry.validate(good)
    assert [r.bri for r in rejected.collect()] == ["c"]
    row = registry.fill_defaults(valid).first()
    assert (row.bri, row.tag, row.retention, row.metadatatype) == ("a", ["x"], 365, "Metadata")
    assert row.additional_metadata.toPython() == {"k": 1}


def test_delimited_gazetteer_and_config(spark, folder):
    open(f"{folder}/t.csv", "w").write('dbname;tablename;rawdata\nd;t;"{\'a\': 1}"\n')
    assert files.read_delimited(spark, f"{folder}/t.csv").first() == ("d", "t", "{'a': 1}")
    open(f"{folder}/g.csv", "w").write("Peru,country \nLima,city\n")
    rows = files.read_gazetteer(spark, f"{folder}/g.csv").collect()
    assert sorted(map(tuple, rows)) == [("Lima", "city"), ("Peru", "country")]
    config = {"End": [], "Start": ["a", "b"]}
    files.write_activity_config(spark, config, f"{folder}/config")
    assert files.read_activity_config(spark, f"{folder}/config") == config


def test_rule_files(spark, folder):
    rules = suggest_rules(transactions(spark, 200), "t")
    files.write_rules_csv(rules, f"{folder}/rules")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/rules")
    want = {tuple(r) for r in rules.select(*files.SIX_COLUMNS).collect()}
    assert {tuple(r) for r in back.collect()} == want
    files.write_rule_views(rules, folder)
    assert "dbt_rule_name" in spark.read.option("header", True).csv(f"{folder}/dbt_rules").columns
    assert "ge_rule_name" in spark.read.option("header", True).csv(f"{folder}/ge_rules").columns


def test_tables_and_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    df = spark.createDataFrame([(1, "x", "y")], "id INT, part STRING, s STRING")
    df.write.mode("overwrite").partitionBy("part").saveAsTable("sales.orders")
    tables.overwrite_table(df, "sales.items", "id", 2)
    assert tables.read_columns(spark, "sales.items", ["s"]).columns == ["s"]
    df.write.mode("overwrite").saveAsTable("sales.plain")
    tables.append_table(df, "sales.plain")
    assert spark.table("sales.plain").count() == 2
    spark.sql("DROP TABLE sales.plain")
    spark.sql("CREATE OR REPLACE VIEW sales.summary AS SELECT o.id FROM sales.orders o JOIN `sales`.`items` i ON o.id = i.id")
    rows = {(r.table_name, r.column_name): r for r in catalog.catalog_metadata(spark, ["sales"]).collect()}
    assert set(rows) == {("orders", "id"), ("orders", "s"), ("orders", "part"), ("items", "id"),
                         ("items", "part"), ("items", "s"), ("summary", "id")}
    assert rows["orders", "part"].is_partitioned == "YES" and rows["orders", "id"].is_partitioned == "NO"
    view = rows["summary", "id"]
    assert (view.is_view, view.dependent_tables, view.source_type) == ("YES", "sales.orders, sales.items", "Hive")
    assert rows["items", "id"].dependent_tables is None and rows["items", "id"].is_nullable == "YES"
    both = catalog.unify(catalog.catalog_metadata(spark, ["sales"]), catalog.catalog_metadata(spark, ["sales"]))
    assert both.count() == 14 and both.columns == catalog.UNIFIED_COLUMNS
    assert set(dict(both.dtypes).values()) == {"string"}


def test_view_dependencies(spark):
    texts = ["select * from `a`.`b` x join `c.d` on 1=1 JOIN e.f", "select 1", None, "FROM a.b, x from  a.b"]
    df = spark.createDataFrame([(t,) for t in texts], "view_text STRING")
    got = [r.dependent_tables for r in catalog.view_dependencies(df).collect()]
    assert got == ["a.b, c.d, e.f", None, None, "a.b"]


def test_connector_settings():
    assert "FROM information_schema.columns" in jdbc.columns_query("PostgreSQL")
    assert jdbc.columns_query("Trino").startswith("SELECT 'Trino' AS source_type, table_catalog")
    options = streams.kafka_options("h:9092", "metadata_events", 5)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"


# --- the registry stream ------------------------------------------------------------------------


def made_events(n, seed, keys=12):
    """Events of a hot key and others, with odd ones, explicit nulls and two different events of one number."""
    rnd, lines = random.Random(seed), []
    for seq in range(n):
        bri = rnd.choice(["hot", f"k{rnd.randrange(keys)}"])
        action = rnd.choices(["create", "update", "delete", "odd"], [3, 6, 2, 1])[0]
        if action == "delete":
            event = {"seq": seq, "action": action, "bri": bri}
        else:
            meta = {"bri": bri, "name": f"n{seq}", "datatype": "d"}
            if rnd.random() < 0.5:
                meta["businessTitle"] = rnd.choice([None, f"t{seq}"])
            event = {"seq": seq, "action": action, "metadata": meta}
        lines.append(json.dumps(event))
        if rnd.random() < 0.05:
            lines.append(json.dumps({"seq": seq, "action": "update", "metadata": {"bri": bri, "name": f"z{seq}"}}))
    return lines


def parts_as_stream(spark, folder, parts, **options):
    """Feed each part as one batch; returns the registry's folder."""
    source, path = f"{folder}/in", f"{folder}/registry"
    os.mkdir(source)
    for i, part in enumerate(parts):
        open(f"{source}/{i:03d}.txt", "w").write("\n".join(part) + "\n")
        os.utime(f"{source}/{i:03d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    events = streams.file_events(spark, source, files_per_batch=1)
    run = registry_stream.stream_registry(events, path, buckets=3, once=True, rows_per_group=40, **options)
    assert run.awaitTermination(600) and run.exception() is None
    return path


def frame(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    return df.select("value", F.get_json_object("value", "$.seq").cast("bigint").alias("seq"))


def in_one_batch(spark, lines):
    """(living fields by key, status by event, dead letters) without a stream."""
    parsed, dead = registry.parse_events(frame(spark, lines))
    single = registry.distinct_events(parsed).cache()
    counted = single.filter("counts")
    living = {r.bri: r.fields for r in registry.current(counted).collect()}
    rows = registry.fold_events(counted).select("bri", "seq", "action", "fields", "status")
    lost = single.filter("NOT counts").select("bri", "seq", "action", "fields", F.lit("rejected_same_seq"))
    return living, statuses(rows.union(lost)), dead.count()


def statuses(df):
    found = [((r.bri, r.seq, r.action, json.dumps(r.fields, sort_keys=True)), r.status) for r in df.collect()]
    assert len(dict(found)) == len(found)
    return dict(found)


def living(spark, path):
    return {r.bri: r.fields for r in registry_stream.read_registry(spark, path).collect()}


def written(spark, path, kind, batch):
    return spark.read.schema("bri STRING").parquet(f"{path}/{kind}/batch={batch}").count()


@pytest.mark.parametrize("dealing", ["in order", "shuffled", "reversed"])
def test_stream_equals_batch_however_events_are_dealt(spark, folder, dealing):
    lines = made_events(240, 3)
    dealt = lines[::-1] if dealing == "reversed" else list(lines)
    if dealing == "shuffled":
        random.Random(5).shuffle(dealt)
    size = len(dealt) // 4 + 1
    parts = [dealt[i: i + size] for i in range(0, len(dealt), size)]
    path = parts_as_stream(spark, folder, parts)
    want, fates, dead = in_one_batch(spark, lines)
    assert living(spark, path) == want and want
    assert statuses(registry_stream.read_changes(spark, path)) == fates
    assert "rejected_same_seq" in fates.values()
    assert spark.read.parquet(f"{path}/dead").count() == dead > 0


def test_replays_and_compaction_change_nothing(spark, folder):
    lines = made_events(120, 4)
    path = parts_as_stream(spark, folder, [lines[:70], lines[70:]])
    want, fates, _ = in_one_batch(spark, lines)
    again = frame(spark, lines[70:])
    registry_stream.apply_batch(again, 1, path, buckets=3)  # the same batch once more
    assert living(spark, path) == want
    assert registry_stream.compact(spark, path) == 1
    assert living(spark, path) == want and statuses(registry_stream.read_changes(spark, path)) == fates
    registry_stream.apply_batch(again, 2, path, buckets=3)  # the same events in a later batch
    assert living(spark, path) == want and statuses(registry_stream.read_changes(spark, path)) == fates
    assert written(spark, path, "changes", 2) == 0
    late = json.dumps({"seq": -1, "action": "create", "metadata": {"bri": "hot", "name": "first", "datatype": "d"}})
    registry_stream.apply_batch(frame(spark, [late]), 3, path, buckets=3)  # after a base, before all others
    want, fates, _ = in_one_batch(spark, [*lines, late])
    assert living(spark, path) == want and statuses(registry_stream.read_changes(spark, path)) == fates
    with pytest.raises(ValueError, match="3 buckets, not 4"):
        registry_stream.apply_batch(again, 4, path, buckets=4)


def test_a_batch_writes_only_its_keys(spark, folder):
    def create(i, seq):
        return json.dumps({"seq": seq, "action": "create", "metadata": {"bri": f"k{i}", "name": "n", "datatype": "d"}})

    path = f"{folder}/registry"
    registry_stream.apply_batch(frame(spark, [create(i, i) for i in range(2000)]), 0, path, buckets=4)
    changes = [json.dumps({"seq": 5000 + i, "action": "update", "metadata": {"bri": f"k{i}", "name": "m"}})
               for i in range(10)]
    registry_stream.apply_batch(frame(spark, changes), 1, path, buckets=4)
    assert written(spark, path, "state", 1) == written(spark, path, "changes", 1) == 10
    found = living(spark, path)
    assert len(found) == 2000 and found["k3"]["name"] == "m" and found["k10"]["name"] == "n"
    registry_stream.apply_batch(frame(spark, ["broken"]), 2, path, buckets=4)  # no event at all
    assert len(living(spark, path)) == 2000


def test_json_documents_are_written_by_many_tasks(spark, folder):
    """One file per document, but not all made by one task when the input is one part."""
    import glob

    from lakewarden.plans import profiling
    from lakewarden.settings import work_dir

    n = 2500
    supplier = spark.range(n).select(
        F.col("id").alias("s_suppkey"), F.format_string("S%d", "id").alias("s_name"),
        (F.col("id") % 25).cast("int").alias("s_nationkey"), F.lit(1.0).alias("s_acctbal"))
    supplier.coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    before = set(glob.glob(f"{work_dir(spark)}/documents-*"))
    result = profiling.ingest_json_files(spark, folder)
    assert sorted(int(r.bri) for r in result.collect()) == list(range(n))
    [written] = set(glob.glob(f"{work_dir(spark)}/documents-*")) - before
    names = [os.path.basename(p) for p in glob.glob(f"{written}/part-*")]
    assert len(names) == n
    assert len({name.split("-")[1] for name in names}) > 1
