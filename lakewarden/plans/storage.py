"""Queries that write a given table, or metadata made from it, and read it back."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lakewarden.operators import catalog, registry, suggest
from lakewarden.operators.quality import run_rules
from lakewarden.operators.reshape import column_dictionary, unpivot_cells
from lakewarden.operators.tagging import capitalized, tag_values
from lakewarden.plans.catalogue import query, read
from lakewarden.plans.registry import _CURRENT, _changes, _image
from lakewarden.settings import fresh_path
from lakewarden.sources import files, jdbc, tables

# --- catalog tables ------------------------------------------------------------------------------


def _database(spark, folder: str, kind: str) -> str:
    """An empty database of this folder's own."""
    name = f"lake_{kind}_{hashlib.md5(folder.encode()).hexdigest()[:12]}"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_path(spark, name)}'")
    return name


_LISTED = ["region", "nation", "supplier", "part", "orders", "events", "documents"]


@query(f"""WITH c AS (SELECT table_name, column_name, CASE data_type WHEN 'INTEGER' THEN 'int'
        WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type
    FROM information_schema.columns WHERE table_name IN ({', '.join(f"'{t}'" for t in _LISTED)}))
    SELECT 'Hive' AS source_type, CAST(NULL AS VARCHAR) AS schema_name, table_name, column_name, data_type,
        'YES' AS is_nullable, 'NO' AS is_partitioned, 'NO' AS is_view, CAST(NULL AS VARCHAR) AS dependent_tables FROM c
    UNION ALL SELECT 'Hive', NULL, 'names', column_name, data_type, 'YES', 'NO', 'YES', 'd.nation, d.region' FROM c
    WHERE (table_name, column_name) IN (('nation', 'n_name'), ('region', 'r_name'))""")
def catalog_listing(spark, folder):
    """The metadata of a database with tables over the folder's files and a view of two of them."""
    db = _database(spark, folder, "catalog")
    for t in _LISTED:
        spark.sql(f"CREATE TABLE {db}.{t} USING parquet LOCATION '{folder}/{t}.parquet'")
    spark.sql(f"""CREATE VIEW {db}.names AS SELECT n_name, r_name FROM {db}.nation
        JOIN `{db}`.`region` ON n_regionkey = r_regionkey""")
    listed = catalog.catalog_metadata(spark, [db]).filter(F.col("database_name") == db)
    named = F.replace("dependent_tables", F.lit(db), F.lit("d"))
    return listed.withColumn("dependent_tables", named).drop("database_name")


_CATALOGS = {
    "Hive": {"region": ["r_regionkey", "r_name"], "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]},
    "PostgreSQL": {"supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], "nation": ["n_nationkey", "n_name", "n_regionkey"]},
}


@query(f"""WITH cells AS ({' UNION ALL '.join(
        f"SELECT '{source}' AS source_type, '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_cells FROM {t}"
        for source, own in _CATALOGS.items() for t, names in own.items() for c in names)})
    SELECT source_type, CASE source_type WHEN 'PostgreSQL' THEN 'public' END AS schema_name, table_name, column_name,
        CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type,
        'YES' AS is_nullable, n_cells
    FROM cells JOIN information_schema.columns USING (table_name, column_name)""")
def unified_catalogs(spark, folder):
    """Two listings in one: a walk over a catalog, and the query that a database answers about its columns; and the
    number of cells of each column listed."""
    listed = []
    for source, own in _CATALOGS.items():
        db = _database(spark, folder, f"of_{source.lower()}")
        for t in own:
            spark.sql(f"CREATE TABLE {db}.{t} USING parquet LOCATION '{folder}/{t}.parquet'")
        listed.append(catalog.catalog_metadata(spark, [db], source).filter(F.col("database_name") == db))
    # What the second database would keep about itself, under the name it would have there.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS information_schema LOCATION '{fresh_path(spark, 'information_schema')}'")
    columns = listed[1].select(
        F.lit("shop").alias("table_catalog"), F.lit("public").alias("table_schema"),
        "table_name", "column_name", "data_type", "is_nullable")
    columns.write.mode("overwrite").option("path", fresh_path(spark, "columns")).saveAsTable("information_schema.columns")
    answered = spark.sql(jdbc.columns_query("PostgreSQL"))
    unified = catalog.unify(listed[0], answered)
    counts = None
    for source, own in _CATALOGS.items():
        for t in own:
            table = read(spark, folder, t)
            cells = unpivot_cells(table).groupBy("id").agg(F.count(F.lit(1)).alias("n_cells"))
            part = cells.join(column_dictionary(table), "id").select(
                F.lit(t).alias("table_name"), F.col("columnname").alias("column_name"), "n_cells")
            counts = part if counts is None else counts.unionByName(part)
    return unified.join(counts, ["table_name", "column_name"]).select(
        "source_type", "schema_name", "table_name", "column_name", "data_type", "is_nullable", "n_cells")


@query("""SELECT o_orderkey, o_orderpriority FROM orders UNION ALL
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def table_round_trip(spark, folder):
    """Orders written as a bucketed catalog table, some appended to it again, and two columns read."""
    db = _database(spark, folder, "tables")
    orders = read(spark, folder, "orders")
    tables.overwrite_table(orders, f"{db}.orders")
    tables.append_table(orders.filter("o_orderstatus = 'P'"), f"{db}.orders")
    tables.overwrite_table(tables.read_columns(spark, f"{db}.orders", ["o_orderkey", "o_orderpriority"]),
                           f"{db}.slim", "o_orderkey", 4)
    return tables.read_columns(spark, f"{db}.slim", ["o_orderkey", "o_orderpriority"])


@query("""SELECT event_id, user_id AS workflow_id, event_type AS activity, coalesce(s.standardized_value, event_type) AS standard
    FROM events LEFT JOIN (VALUES ('click', 'Press'), ('view', 'Look')) s(input_value, standardized_value)
    ON event_type = input_value""")
def workflow_tables(spark, folder):
    """Activities and standards read from catalog tables by their fixed columns."""
    db = _database(spark, folder, "workflow")
    made = read(spark, folder, "events").selectExpr(
        "user_id AS workflow_id", "event_type AS activity", "cast(event_id as string) AS activity_status",
        "ts AS activity_completion_time", "cast(null as string) AS activity_parent", "props AS activity_out", "value")
    tables.overwrite_table(made, f"{db}.activities")
    standards = spark.sql("SELECT * FROM VALUES ('click', 'Press'), ('view', 'Look') t(input_value, standardized_value)")
    tables.overwrite_table(standards, f"{db}.standards")
    found = tables.read_activities(spark, f"{db}.activities")
    joined = found.join(tables.read_standards(spark, f"{db}.standards"), found["activity"] == F.col("input_value"), "left")
    return joined.select(
        F.col("activity_status").cast("bigint").alias("event_id"), "workflow_id", "activity",
        F.coalesce("standardized_value", "activity").alias("standard"))


# --- files ---------------------------------------------------------------------------------------


@query("""SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS shown,
    c_mktsegment = 'BUILDING' AS builds, c_mktsegment = 'FURNITURE' AS furnishes FROM customer""")
def gazetteer_file(spark, folder):
    """Segments written as a gazetteer file, read back, and looked up for every customer."""
    customer = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    path = fresh_path(spark, "gazetteer")
    segments = customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.lower("c_mktsegment").alias("term"), F.concat("c_mktsegment", F.lit(" code  ")).alias("label")).distinct()
    segments.write.option("ignoreTrailingWhiteSpace", False).csv(path)
    labels = {"builds": "BUILDING code", "furnishes": "FURNITURE code"}
    tagged = tag_values(customer, "c_mktsegment", files.read_gazetteer(spark, path), labels)
    return tagged.select("c_custkey", capitalized(F.col("c_mktsegment")).alias("shown"), *labels)


@query("""SELECT 'r' AS table_name, column_name, rule FROM (VALUES ('id', 'not_null'), ('id', 'relationships.range'),
    ('id', 'expression_is_true'), ('r_name', 'not_null'), ('r_name', 'expression_is_true'), ('r_name', 'accepted_values'),
    ('ALL_COLUMNS', 'row_count'), ('id', 'unique')) t(column_name, rule) WHERE (SELECT count(*) FROM region) > 0""")
def rules_file(spark, folder):
    """Rules suggested for regions whose key is named id, written as CSV and read back."""
    path = fresh_path(spark, "rules")
    region = read(spark, folder, "region").withColumnRenamed("r_regionkey", "id")
    files.write_rules_csv(suggest.suggest_rules(region, "r"), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select("table_name", "column_name", F.col("dbt_rule_name").alias("rule"))


_SAMPLED = [
    ("o_orderkey", "not_null"), ("o_orderkey", "relationships.range"), ("o_orderkey", "expression_is_true"),
    ("id", "not_null"), ("id", "relationships.range"), ("id", "expression_is_true"),
    ("o_orderstatus", "not_null"), ("o_orderstatus", "expression_is_true"), ("o_orderstatus", "accepted_values"),
    ("o_totalprice", "not_null"), ("o_totalprice", "relationships.range"), ("o_totalprice", "expression_is_true"),
    ("o_orderdate", "not_null"), ("o_orderdate", "expression_is_true"), ("o_orderdate", "expression_is_true"),
    ("o_orderpriority", "not_null"), ("o_orderpriority", "expression_is_true"), ("o_orderpriority", "accepted_values"),
    ("ALL_COLUMNS", "row_count"), ("id", "unique"),
]


@query(f"""WITH r AS (SELECT CAST(row_number() OVER () AS INTEGER) AS rule_seq, * FROM (VALUES {', '.join(map(str, _SAMPLED))})
        t(column_name, rule)),
    n AS (SELECT count(*) AS n FROM orders)
    SELECT rule_seq, column_name, rule, CASE WHEN rule = 'row_count' THEN 0.8::DOUBLE * n END AS fewest,
        CASE WHEN rule = 'row_count' THEN 1.2::DOUBLE * n END AS most FROM r, n""")
def sampled_suggestions(spark, folder):
    """Rules from a sample, on request: as many as from the whole table, whose row count they are about."""
    orders = read(spark, folder, "orders").withColumnRenamed("o_custkey", "id")
    rules = suggest.suggest_rules(orders, "orders", sample_size=500)
    counted = F.col("dbt_rule_name") == "row_count"
    return rules.select(
        "rule_seq", "column_name", F.col("dbt_rule_name").alias("rule"),
        F.when(counted, F.col("min_value")).alias("fewest"), F.when(counted, F.col("max_value")).alias("most"))


# --- registry and rule runs ----------------------------------------------------------------------


@query(f"""WITH found AS ({_CURRENT}) SELECT * FROM found WHERE bri = (SELECT min(bri) FROM found)""")
def registry_entity(spark, folder):
    """One living entity, by its identifier."""
    living = registry.current(_changes(spark, folder))
    return _image(registry.find_entity(living, living.agg(F.min("bri")).first()[0]))


def _stored_rules(spark):
    return spark.sql("""SELECT * FROM VALUES
        (1, 'b', 'expect_column_values_to_be_between', '{"column": "o_totalprice", "max": 250000}', 'reject'),
        (2, 'b', 'expect_column_values_to_be_between', '{"column": "o_orderstatus", "max": 3}', 'reject'),
        (3, 'b', 'expect_column_values_to_be_in_set', '{"column": "o_orderstatus", "values": ["F", "O"], "default": "?"}',
            'transform'),
        (4, 'b', 'expect_column_values_to_be_in_set', '{"column": "o_custkey", "values": [1], "default": "none"}',
            'transform'),
        (5, 'other', 'expect_column_values_to_not_be_null', '{"column": "o_custkey"}', 'reject')
        t(id, bri, rule_type, rule_parameters, action)""")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE '?' END AS o_orderstatus
    FROM orders WHERE o_totalprice <= 250000""")
def dq_cleaned(spark, folder):
    """The cleaned rows of stored rules; two of the rules cannot be evaluated and stop nothing."""
    cleaned, _, _ = run_rules(read(spark, folder, "orders"), _stored_rules(spark), "b")
    return cleaned.select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, [1] AS failed_rules FROM orders WHERE o_totalprice > 250000")
def dq_quarantine_run(spark, folder):
    _, quarantine, _ = run_rules(read(spark, folder, "orders"), _stored_rules(spark), "b")
    return quarantine.select("o_orderkey", "failed_rules")


@query("""SELECT CAST(rule AS INTEGER) AS rule_seq, rule IN (1, 3) AS evaluated, CASE rule
    WHEN 1 THEN (SELECT count(*) FROM orders WHERE o_totalprice > 250000)
    WHEN 3 THEN (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) END AS unexpected_count
    FROM range(1, 5) t(rule)""")
def dq_run_report(spark, folder):
    _, _, report = run_rules(read(spark, folder, "orders"), _stored_rules(spark), "b")
    return report.select("rule_seq", F.col("exception").isNull().alias("evaluated"), "unexpected_count")
