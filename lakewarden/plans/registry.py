"""Activity, registry, lineage and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import activity as act
from lakewarden.operators import catalog, lineage, registry
from lakewarden.operators.skew import numbered
from lakewarden.plans.catalogue import query, read
from lakewarden.settings import fresh_path
from lakewarden.sources.files import read_activity_config, write_activity_config
from lakewarden.sources.streams import file_events
from lakewarden.streaming.registry_stream import compact, read_changes, read_registry, stream_registry

# --- workflow activities: workflow = user_id, activity = event_type -------------------------

_ACTIVITIES = """(SELECT user_id AS workflow_id, event_id, ts AS activity_completion_time,
    CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'Look' WHEN 'signup' THEN 'Click'
        ELSE event_type END AS activity,
    'S' || (event_id % 7) AS activity_status, CAST(event_id % 5 AS VARCHAR) AS activity_parent,
    CASE event_type WHEN 'purchase' THEN replace(props, '}', ', "paid": "' || user_id || '"}')
        WHEN 'error' THEN replace(props, '}', ', "code": [' || user_id || ']}')
        WHEN 'view' THEN NULL ELSE props END AS activity_out FROM events)"""


def _activities(spark, folder):
    kind, props = F.col("event_type"), F.col("props")
    out = (
        F.when(kind == "purchase", F.replace(props, F.lit("}"), F.concat(F.lit(', "paid": "'), "user_id", F.lit('"}'))))
        .when(kind == "error", F.replace(props, F.lit("}"), F.concat(F.lit(', "code": ['), "user_id", F.lit("]}"))))
        .when(kind == "view", F.lit(None))
        .otherwise(props)
    )
    return read(spark, folder, "events").select(
        F.col("user_id").alias("workflow_id"),
        "event_id",
        kind.alias("activity"),
        F.concat(F.lit("S"), F.expr("event_id % 7")).alias("activity_status"),
        F.col("ts").alias("activity_completion_time"),
        F.expr("cast(event_id % 5 as string)").alias("activity_parent"),
        out.alias("activity_out"),
    )


def _standard(spark, folder):
    mapping = spark.sql(
        "SELECT * FROM VALUES ('CLICK', 'Click'), ('View', 'Look'), ('signup', 'Click'), "
        "('SignUp', 'Zap'), ('none', 'x') t(input_value, standardized_value)"
    )
    return act.standardize(_activities(spark, folder), mapping, "activity")


@query(f"SELECT event_id, activity FROM {_ACTIVITIES}")
def standardize_activity(spark, folder):
    return _standard(spark, folder).select("event_id", "activity")


@query("""SELECT DISTINCT event_type AS activity, unnest(json_keys(CASE event_type
    WHEN 'purchase' THEN replace(props, '}', ', "paid": 1}')
    WHEN 'error' THEN replace(props, '}', ', "code": 1}') WHEN 'view' THEN NULL ELSE props END)) AS field
FROM events""")
def discover_fields(spark, folder):
    return act.discover_fields(_activities(spark, folder))


_FLAT_COLUMNS = {"Click": ["k"], "Look": [], "error": ["code", "k"], "purchase": ["k", "paid"]}


def _flat_sql():
    columns = ["workflow_id"]
    for a, own in _FLAT_COLUMNS.items():
        def first(expression, a=a):
            return f"max(CASE WHEN activity = '{a}' AND rn = 1 THEN {expression} END)"

        columns += [
            f'{first("activity_status")} AS "{a}_status"',
            f"""{first("strftime(activity_completion_time, '%Y-%m-%d %H:%M:%S.%f')")} AS "{a}_completion_time\"""",
            f'{first("activity_parent")} AS "{a}_parent"',
        ]
        for f in ("code", "k", "paid"):
            value = first(f"json_extract_string(activity_out, '$.{f}')") if f in own else "CAST(NULL AS VARCHAR)"
            columns.append(f'{value} AS "{a}_{f}"')
    return f"""SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (
        PARTITION BY workflow_id, activity ORDER BY activity_completion_time, event_id) AS rn
        FROM {_ACTIVITIES}) GROUP BY workflow_id"""


@query(_flat_sql())
def flatten_workflow(spark, folder):
    activities = _standard(spark, folder)
    path = fresh_path(spark, "activity-config")
    write_activity_config(spark, act.activity_fields(activities), path)
    fields = read_activity_config(spark, path)
    flat = act.flatten(activities, fields, tiebreak=["event_id"])
    times = {f"{a}_completion_time": F.date_format(f"{a}_completion_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
             for a in fields}
    return flat.withColumns(times)


# --- registry: signup creates, error deletes, all others update --------------------------------

_KEYS = ["name", "datatype", "note"]


def _changes(spark, folder):
    kind = F.col("event_type")
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    fields = F.map_from_entries(
        F.array_compact(
            F.array(
                entry("datatype", kind),
                F.when(kind.isin("signup", "view"), entry("name", F.col("props"))),
                F.when(kind == "purchase", entry("note", F.col("value"))),
                F.when(kind == "click", entry("note", F.lit(None))),
            )
        )
    )
    action = F.when(kind == "signup", "create").when(kind == "error", "delete").otherwise("update")
    return read(spark, folder, "events").select(
        F.concat(F.lit("user:"), "user_id").alias("bri"), F.col("event_id").alias("seq"),
        action.alias("action"), fields.alias("fields"),
    )


_FOLD = """WITH e AS (SELECT 'user:' || user_id AS bri, event_id AS seq, event_type, props, value,
        CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS action
        FROM events),
    g AS (SELECT *, coalesce(sum(CASE WHEN action = 'delete' THEN 1 ELSE 0 END) OVER (
        PARTITION BY bri ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM e),
    c AS (SELECT *, sum(CASE WHEN action = 'create' THEN 1 ELSE 0 END) OVER (
        PARTITION BY bri, epoch ORDER BY seq) AS creates FROM g),
    s AS (SELECT *, CASE WHEN action = 'create' THEN CASE WHEN creates = 1 THEN 'applied'
        ELSE 'rejected_duplicate' END WHEN creates >= 1 THEN 'applied' ELSE 'ignored_missing' END AS status,
        max(epoch) OVER (PARTITION BY bri) AS last_epoch FROM c)"""
_CURRENT = f"""{_FOLD}, l AS (SELECT * FROM s WHERE epoch = last_epoch AND status = 'applied')
    SELECT bri, arg_max(event_type, seq) AS datatype,
        arg_max(props, seq) FILTER (event_type IN ('signup', 'view')) AS name,
        (arg_max({{'v': CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) END}}, seq)
            FILTER (event_type IN ('purchase', 'click'))).v AS note
    FROM l GROUP BY bri HAVING count(*) FILTER (action = 'delete') = 0"""


@query(f"{_FOLD} SELECT bri, seq, action, status FROM s")
def registry_events(spark, folder):
    return registry.fold_events(_changes(spark, folder)).select("bri", "seq", "action", "status")


def _image(living):
    return living.select("bri", *[F.element_at("fields", F.lit(f)).alias(f) for f in _KEYS])


@query(_CURRENT)
def registry_current(spark, folder):
    return _image(registry.current(_changes(spark, folder), _KEYS))


@query(f"""{_FOLD} SELECT bri, seq, action, row_number() OVER (PARTITION BY bri ORDER BY seq) AS version
    FROM s WHERE status = 'applied'""")
def registry_history(spark, folder):
    return registry.history(_changes(spark, folder)).select("bri", "seq", "action", "version")


def _event_lines(spark, folder):
    e = _changes(spark, folder)
    metadata = F.map_concat("fields", F.create_map(F.lit("bri"), "bri"))
    # A create needs a name and a datatype, which every signup has.
    event = F.struct(
        "seq", "action",
        F.when(F.col("action") == "delete", F.col("bri")).alias("bri"),
        F.when(F.col("action") != "delete", metadata).alias("metadata"),
    )
    options = {"ignoreNullFields": "false"}
    return e.select("seq", F.to_json(event, options).alias("value"))


def _streamed(spark, folder) -> str:
    """The events written in four parts, after each of which the stream takes what is new. A seventh of the events
    come late, one part after their own; the registry is compacted half way."""
    source, path = fresh_path(spark, "events"), fresh_path(spark, "registry")
    lines = _event_lines(spark, folder)
    low, high = lines.agg(F.coalesce(F.min("seq"), F.lit(0)), F.coalesce(F.max("seq"), F.lit(0))).first()
    own = F.floor((F.col("seq") - low) * 4 / (high - low + 1))
    part = F.when(F.col("seq") % 7 == 0, F.least(own + 1, F.lit(3))).otherwise(own)
    for i in range(4):
        lines.filter(part == i).select("value").write.mode("append").text(source)
        stream_registry(file_events(spark, source), path, buckets=8, once=True).awaitTermination()
        if i == 1:
            compact(spark, path)
    return path


@query(_CURRENT)
def registry_stream(spark, folder):
    """The stream of JSON events, folded in several batches and runs with late events, ends in the same registry."""
    return _image(read_registry(spark, _streamed(spark, folder)))


@query(f"{_FOLD} SELECT bri, seq, status FROM s")
def registry_stream_changes(spark, folder):
    return read_changes(spark, _streamed(spark, folder)).select("bri", "seq", "status")


@query("""SELECT doc_id AS seq, CASE WHEN lang = 'en' THEN 'missing: datatype, name'
    WHEN lang = 'de' THEN 'unknown action' WHEN lang = 'fr' THEN 'not an event' END AS reason
FROM documents WHERE lang <> 'es'""")
def dead_letters(spark, folder):
    """Events made from documents, most of them broken in some way."""
    lang = F.col("lang")
    meta = F.struct(F.col("source").alias("bri"), F.when(lang == "es", F.col("text")).alias("name"),
                    F.when(lang == "es", lang).alias("datatype"))
    action = F.when(lang == "de", "rename").otherwise("create")
    text = F.to_json(F.struct(action.alias("action"), meta.alias("metadata")))
    lines = read(spark, folder, "documents").select(
        F.col("doc_id").alias("seq"), F.when(lang == "fr", F.substr(text, F.lit(2))).otherwise(text).alias("value"))
    _, dead = registry.parse_events(lines)
    return dead.select("seq", "reason")


@query("""SELECT c_name AS bri, coalesce(nullif(c_mktsegment, 'BUILDING'), 'relational') AS metadataclass,
    'Metadata' AS metadatatype, CAST(365 AS INTEGER) AS retention, false AS nullable
FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def registry_create(spark, folder):
    """Validation and defaults of new entities."""
    segment = F.col("c_mktsegment")
    customer = read(spark, folder, "customer").select(
        F.col("c_name").alias("bri"), F.col("c_name").alias("name"),
        F.nullif(segment, F.lit("MACHINERY")).alias("datatype"),
        F.nullif(segment, F.lit("BUILDING")).alias("metadataclass"))
    valid, _ = registry.validate(customer)
    return registry.fill_defaults(valid).select(
        "bri", "metadataclass", "metadatatype", "retention", "nullable")


@query("""SELECT c_name AS bri, 'missing: datatype' AS reason FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def registry_rejects(spark, folder):
    segment = F.col("c_mktsegment")
    customer = read(spark, folder, "customer").select(
        F.col("c_name").alias("bri"), F.col("c_name").alias("name"),
        F.nullif(segment, F.lit("MACHINERY")).alias("datatype"))
    _, rejected = registry.validate(customer)
    return rejected.select("bri", "reason")


# --- entities with child columns: nations and customers ---------------------------------------


def _entities(spark, folder):
    metadata = read(spark, folder, "nation").select(
        F.concat(F.lit("nation:"), "n_nationkey").alias("bri"), F.col("n_name").alias("description"),
        F.col("n_regionkey").alias("region"))
    columns = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("nation:"), "c_nationkey").alias("bri"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("data_type"))
    return metadata, columns


@query("""SELECT bri, description, CAST(part AS INTEGER) AS part, count(id) AS n_columns,
        coalesce(string_agg(id || '=' || name, ',' ORDER BY id), '') AS columns
    FROM (SELECT 'nation:' || n_nationkey AS bri, n_name AS description, c_custkey AS id, c_name AS name,
        coalesce((row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) - 1) // 25, 0) AS part
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey)
    GROUP BY bri, description, part""")
def metadata_with_columns(spark, folder):
    metadata, columns = _entities(spark, folder)
    nested = registry.with_columns(metadata, columns, part_size=25)
    shown = F.transform("columns", lambda c: F.concat(c["id"].cast("string"), F.lit("="), c["name"]))
    return nested.select(
        "bri", "description", "part", F.size("columns").cast("bigint").alias("n_columns"),
        F.array_join(shown, ",").alias("columns"))


@query("""SELECT id, bri, name, data_type FROM (
    WITH u AS (SELECT o_custkey + 700 AS id, o_orderkey AS seq, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
    f AS (SELECT id, arg_max(pr, seq) FILTER (st = 'F') AS pr, count(*) FILTER (st = 'F') AS n_pr,
        count(*) FILTER (st = 'O') AS n_name FROM u GROUP BY id)
    SELECT coalesce(c_custkey, id) AS id, coalesce('nation:' || c_nationkey, 'nation:0') AS bri,
        CASE WHEN n_name > 0 THEN NULL ELSE c_name END AS name,
        CASE WHEN n_pr > 0 THEN pr ELSE c_mktsegment END AS data_type
    FROM customer FULL OUTER JOIN f ON c_custkey = id)""")
def upsert_columns(spark, folder):
    """Customers overlaid by the changes that their orders stand for."""
    metadata, columns = _entities(spark, folder)
    status = F.col("o_orderstatus")
    fields = (
        F.when(status == "F", F.create_map(F.lit("data_type"), "o_orderpriority"))
        .when(status == "O", F.create_map(F.lit("name"), F.lit(None).cast("string")))
        .otherwise(F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))
    )
    updates = read(spark, folder, "orders").select(
        (F.col("o_custkey") + 700).alias("id"), F.col("o_orderkey").alias("seq"),
        F.lit("nation:0").alias("bri"), fields.alias("fields"))
    return registry.upsert_columns(columns, updates, metadata)


_GONE = "SELECT n_nationkey FROM nation WHERE n_regionkey = 1"


@query(f"""SELECT 'nation' AS kind, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey NOT IN ({_GONE})
    UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_nationkey NOT IN ({_GONE})""")
def cascade_delete(spark, folder):
    metadata, columns = _entities(spark, folder)
    gone = metadata.filter("region = 1").select("bri")
    left, cols = registry.delete_cascade(metadata, columns, gone)
    number = F.substring_index("bri", ":", -1).cast("bigint")
    return left.select(F.lit("nation").alias("kind"), number.alias("id")).union(
        cols.select(F.lit("customer"), "id"))


# --- lineage: region -> nation -> customer and supplier -> order -----------------------------

_EDGES = """(SELECT row_number() OVER (ORDER BY a, b) AS id, a AS input_bri, b AS output_bri, m AS movement_type,
    CAST(1 AS INTEGER) AS relationship_level FROM (
    SELECT 'r' || n_regionkey AS a, 'n' || n_nationkey AS b, 'split' AS m FROM nation
    UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, 'copy' FROM customer
    UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, 'copy' FROM supplier
    UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, 'load' FROM orders
    UNION ALL SELECT DISTINCT 's' || l_suppkey, 'o' || l_orderkey, 'load' FROM lineitem))"""


def _edges(spark, folder):
    def part(table, a, key, b, to, kind):
        return read(spark, folder, table).select(
            F.concat(F.lit(a), key).alias("input_bri"), F.concat(F.lit(b), to).alias("output_bri"),
            F.lit(kind).alias("movement_type"))

    supplied = read(spark, folder, "lineitem").select(
        F.concat(F.lit("s"), "l_suppkey").alias("input_bri"),
        F.concat(F.lit("o"), "l_orderkey").alias("output_bri"), F.lit("load").alias("movement_type"))
    plain = (
        part("nation", "r", "n_regionkey", "n", "n_nationkey", "split")
        .union(part("customer", "n", "c_nationkey", "c", "c_custkey", "copy"))
        .union(part("supplier", "n", "s_nationkey", "s", "s_suppkey", "copy"))
        .union(part("orders", "c", "o_custkey", "o", "o_orderkey", "load"))
        .union(supplied.distinct())
    )
    edges = numbered(plain, [], ["input_bri", "output_bri"], "id").withColumn("relationship_level", F.lit(1))
    path = fresh_path(spark, "edges")
    edges.write.parquet(path)
    return spark.read.parquet(path)


_WALK = f"""WITH RECURSIVE edge AS (SELECT * FROM {_EDGES}), walk AS (
    SELECT input_bri, output_bri, movement_type, 0 AS level, input_bri || '>' || output_bri AS path
    FROM edge WHERE input_bri IN ('r1', 'r3')
    UNION ALL SELECT e.input_bri, e.output_bri, e.movement_type, w.level + 1, w.path || '>' || e.output_bri
    FROM walk w JOIN edge e ON e.input_bri = w.output_bri)"""


@query(f"{_WALK} SELECT input_bri, output_bri, movement_type, CAST(level AS INTEGER) AS level, path FROM walk")
def lineage_downstream(spark, folder):
    found = lineage.downstream(_edges(spark, folder), ["r1", "r3"])
    return found.select(
        "input_bri", "output_bri", "movement_type", "level", F.array_join("path", ">").alias("path"))


@query(f"""{_WALK} SELECT input_bri, output_bri, CAST(min(level) AS INTEGER) AS level FROM walk
    GROUP BY input_bri, output_bri""")
def lineage_distinct_edges(spark, folder):
    found = lineage.downstream(_edges(spark, folder), ["r1", "r3"], distinct_edges=True)
    return found.select("input_bri", "output_bri", "level")


@query(f"""WITH edge AS (SELECT * FROM {_EDGES}) SELECT id, input_bri, output_bri FROM edge
    WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def lineage_delete(spark, folder):
    gone = read(spark, folder, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    return lineage.delete_edges(_edges(spark, folder), gone).select("id", "input_bri", "output_bri")


@query(f"""WITH edge AS (SELECT * FROM {_EDGES}) SELECT id, input_bri, output_bri FROM edge
    UNION ALL SELECT (SELECT max(id) FROM edge) + row_number() OVER (ORDER BY 'p' || p_partkey), 'p' || p_partkey, p_brand FROM part""")
def lineage_add(spark, folder):
    new = read(spark, folder, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("input_bri"), F.col("p_brand").alias("output_bri"),
        F.lit("sort").alias("movement_type"), F.lit(1).alias("relationship_level"))
    return lineage.add_edges(_edges(spark, folder), new).select("id", "input_bri", "output_bri")


# --- catalogs ------------------------------------------------------------------------------

_LISTED = {
    "Hive": ("part", "p_brand", "NULL", "p_name", "p_type", "YES"),
    "PostgreSQL": ("supplier", "'db'", "'public'", "s_name", "s_nationkey", "NO"),
    "Trino": ("customer", "c_mktsegment", "'main'", "c_name", "c_nationkey", "NO"),
}


@query("\nUNION ALL\n".join(
    f"""SELECT '{source}' AS source_type, {db} AS database_name, CAST({schema} AS VARCHAR) AS schema_name,
    {name} AS table_name, CAST({column} AS VARCHAR) AS column_name, 'int' AS data_type, 'YES' AS is_nullable,
    'NO' AS is_partitioned, '{view}' AS is_view, CAST(NULL AS VARCHAR) AS dependent_tables FROM {table}"""
    for source, (table, db, schema, name, column, view) in _LISTED.items()))
def unified_metadata(spark, folder):
    """Three column listings, as three catalogs give them, in one."""
    parts = []
    for source, (table, db, schema, name, column, view) in _LISTED.items():
        parts.append(read(spark, folder, table).selectExpr(
            f"'{source}' AS source_type", f"{db} AS database_name", f"{schema} AS schema_name",
            f"{name} AS table_name", f"{column} AS column_name", "'int' AS data_type",
            "'YES' AS is_nullable", "'NO' AS is_partitioned", f"'{view}' AS is_view",
            "NULL AS dependent_tables"))
    return catalog.unify(*parts)


@query("""SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30
    THEN lower(p_type) || '.t' || p_partkey
    ELSE lower(p_type) || '.t' || p_partkey || ', sales.b' || p_size END AS dependent_tables FROM part""")
def view_dependencies(spark, folder):
    text = F.when(F.col("p_size") < 10, F.lit("SELECT 1 AS one")).when(
        F.col("p_size") < 30,
        F.concat(F.lit("SELECT * FROM `"), F.lower("p_type"), F.lit("`.`t"), "p_partkey", F.lit("` x"))
    ).otherwise(
        F.concat(F.lit("select a from "), F.lower("p_type"), F.lit(".t"), "p_partkey",
                 F.lit(" t JOIN `sales.b"), "p_size", F.lit("` u ON t.a = u.a")))
    views = read(spark, folder, "part").select("p_partkey", text.alias("view_text"))
    return catalog.view_dependencies(views).select("p_partkey", "dependent_tables")
