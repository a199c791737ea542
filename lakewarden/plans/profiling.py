"""Profile, suggestion and reshaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import profiling, reshape, suggest
from lakewarden.operators.quality import evaluate
from lakewarden.operators.registry import fill_defaults, validate
from lakewarden.plans.catalogue import query, read
from lakewarden.settings import fresh_path
from lakewarden.sources import files


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile_sql(table, columns) -> str:
    parts = []
    for i, (name, kind) in enumerate(columns):
        number, time, text = kind in ("Integral", "Fractional"), kind == "DateTime", kind == "String"

        def only(wanted, expression, dtype):
            return f"CAST({expression if wanted else 'NULL'} AS {dtype})"

        parts.append(f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name,
            '{kind}' AS data_type, count({name}) / CAST(count(*) AS DOUBLE) AS completeness,
            {only(number, f'min({name})', 'DOUBLE')} AS minimum,
            {only(number, f'max({name})', 'DOUBLE')} AS maximum,
            round({only(number, f'avg({name})', 'DOUBLE')}, 4) AS mean,
            round({only(number, f'stddev_pop({name})', 'DOUBLE')}, 4) AS std_dev,
            {only(time, f"strftime(min({name}), '%Y-%m-%d %H:%M:%S.%f')", 'VARCHAR')} AS first_time,
            {only(time, f"strftime(max({name}), '%Y-%m-%d %H:%M:%S.%f')", 'VARCHAR')} AS last_time,
            {only(text, f'min(length({name}))', 'INTEGER')} AS min_length,
            {only(text, f'max(length({name}))', 'INTEGER')} AS max_length FROM {table}""")
    return _union(parts)


_ORDERS = [("o_orderkey", "Integral"), ("o_custkey", "Integral"), ("o_orderstatus", "String"),
           ("o_totalprice", "Fractional"), ("o_orderdate", "DateTime"), ("o_orderpriority", "String")]
_LINEITEM = [("l_orderkey", "Integral"), ("l_partkey", "Integral"), ("l_suppkey", "Integral"),
             ("l_linenumber", "Integral"), ("l_quantity", "Fractional"),
             ("l_extendedprice", "Fractional"), ("l_discount", "Fractional"), ("l_tax", "Fractional"),
             ("l_returnflag", "String"), ("l_linestatus", "String"), ("l_shipdate", "DateTime")]
_PART = [("p_partkey", "Integral"), ("p_name", "String"), ("p_brand", "String"),
         ("p_type", "String"), ("p_size", "Integral"), ("p_retailprice", "Fractional")]


def _profile(spark, folder, table):
    return profiling.profile(read(spark, folder, table)).withColumns(
        {"mean": F.round("mean", 4), "std_dev": F.round("std_dev", 4)}
    )


@query(_profile_sql("orders", _ORDERS))
def profile_columns(spark, folder):
    return _profile(spark, folder, "orders")


@query(_profile_sql("lineitem", _LINEITEM))
def profile_lineitem(spark, folder):
    return _profile(spark, folder, "lineitem")


_HOLED_CUSTOMER = "(SELECT * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM customer)"
_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(_union(
    f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name,
    count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS n_distinct
    FROM {_HOLED_CUSTOMER}""" for i, c in enumerate(_CUSTOMER)))
def distinct_counts(spark, folder):
    customer = read(spark, folder, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    return profiling.distinct_counts(customer)


@query(_union(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY {c}"
    for c in ("p_name", "p_brand", "p_type", "p_size")))
def value_histogram(spark, folder):
    return profiling.value_histogram(read(spark, folder, "part"), ["p_name", "p_brand", "p_type", "p_size"])


def _suggest_sql(table, columns) -> str:
    """Suggested rules on typed columns; the value set is joined with '|'."""
    parts = []

    def add(order, column, dbt, ge, description, mostly="NULL", low="NULL", high="NULL",
            first="NULL", last="NULL", values="NULL", where="true"):
        parts.append(f"""SELECT {order} AS ord, '{table}' AS table_name, '{column}' AS column_name,
            '{dbt}' AS dbt_rule_name, 'expect_{ge}' AS ge_rule_name, {description} AS description,
            CAST({mostly} AS DOUBLE) AS mostly, CAST({low} AS DOUBLE) AS min_value,
            CAST({high} AS DOUBLE) AS max_value, CAST({first} AS VARCHAR) AS min_time,
            CAST({last} AS VARCHAR) AS max_time, CAST({values} AS VARCHAR) AS value_set
            FROM (SELECT count(*) AS n FROM {table}) WHERE {where}""")

    def scalar(expression):
        return f"(SELECT {expression} FROM {table})"

    for i, (c, kind) in enumerate(columns):
        add(10 * i, c, "not_null", "column_values_to_not_be_null",
            f"'Values in {c} should not be null'", 0.95)
        low, high = scalar(f"min({c})"), scalar(f"max({c})")
        if kind in ("Integral", "Fractional"):
            add(10 * i + 1, c, "relationships.range", "column_values_to_be_between",
                f"printf('Values in {c} should be between %.2f and %.2f', "
                f"CAST({low} AS DOUBLE), CAST({high} AS DOUBLE))", 0.95, low, high)
            add(10 * i + 2, c, "expression_is_true",
                "column_values_to_be_greater_than_or_equal_to",
                f"'Values in {c} should be non-negative'", 0.98, 0, where=f"{low} >= 0")
        elif kind == "String":
            short, long = scalar(f"min(length({c}))"), scalar(f"max(length({c}))")
            add(10 * i + 1, c, "expression_is_true", "column_value_lengths_to_be_between",
                f"printf('String length of {c} should be between %d and %d', {short}, {long})",
                0.95, short, long)
            few = scalar(f"count(DISTINCT {c}) < 20")
            listed = f"(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {table}))"
            quoted = (f"(SELECT string_agg('''' || v || '''', ', ' ORDER BY v) "
                      f"FROM (SELECT DISTINCT {c} AS v FROM {table}))")
            add(10 * i + 2, c, "accepted_values", "column_values_to_be_in_set",
                f"'Values in {c} should be in [' || {quoted} || ']'", 0.99, values=listed, where=few)
        else:
            first, last = (f"strftime({v}, '%Y-%m-%d %H:%M:%S')" for v in (low, high))
            add(10 * i + 1, c, "expression_is_true", "column_values_to_be_between",
                f"'Dates in {c} should be between ' || {first} || ' and ' || {last}",
                0.95, first=first, last=last)
            add(10 * i + 2, c, "expression_is_true", "column_values_to_be_in_past",
                f"'Dates in {c} should be in the past'", 0.99)
    add(1000, "ALL_COLUMNS", "row_count", "table_row_count_to_be_between",
        f"printf('Table {table} should have between %d and %d rows', "
        "CAST(floor(CAST(n AS DOUBLE) * 0.8) AS BIGINT), CAST(floor(CAST(n AS DOUBLE) * 1.2) AS BIGINT))",
        low="CAST(n AS DOUBLE) * 0.8::DOUBLE", high="CAST(n AS DOUBLE) * 1.2::DOUBLE")
    return (
        "SELECT CAST(row_number() OVER (ORDER BY ord) AS INTEGER) AS rule_seq, * EXCLUDE (ord) "
        f"FROM ({_union(parts)})"
    )


def _suggested(spark, folder, table):
    rules = suggest.suggest_rules(read(spark, folder, table), table)
    return rules.withColumn("value_set", F.array_join("value_set", "|")).drop("parameters")


@query(_suggest_sql("orders", _ORDERS))
def suggest_rules(spark, folder):
    return _suggested(spark, folder, "orders")


@query(_suggest_sql("part", _PART))
def suggest_rules_part(spark, folder):
    return _suggested(spark, folder, "part")


@query("SELECT table_name, column_name, dbt_rule_name, description FROM "
       f"({_suggest_sql('part', _PART)})")
def suggest_dbt_view(spark, folder):
    return suggest.dbt_view(suggest.suggest_rules(read(spark, folder, "part"), "part")).drop("parameters")


@query("SELECT table_name, column_name, ge_rule_name, description FROM "
       f"({_suggest_sql('part', _PART)})")
def suggest_ge_view(spark, folder):
    return suggest.ge_view(suggest.suggest_rules(read(spark, folder, "part"), "part")).drop("parameters")


@query(f"SELECT rule_seq, ge_rule_name AS rule_type, column_name, true AS success "
       f"FROM ({_suggest_sql('orders', _ORDERS)})")
def suggested_rules_hold(spark, folder):
    """Every suggested rule can be evaluated and holds on the table it came from."""
    orders = read(spark, folder, "orders")
    report = evaluate(orders, suggest.as_rules(suggest.suggest_rules(orders, "orders")), examples=0)
    name = F.coalesce("column_name", F.lit("ALL_COLUMNS"))
    return report.select("rule_seq", "rule_type", name.alias("column_name"), "success")


@query(_union(
    f"SELECT CAST({i} AS INTEGER) AS id, CAST({c} AS VARCHAR) AS values FROM customer "
    f"WHERE {c} IS NOT NULL" for i, c in enumerate(_CUSTOMER)))
def unpivot_cells(spark, folder):
    return reshape.unpivot_cells(read(spark, folder, "customer"))


@query(_union(
    f"SELECT CAST({i} AS INTEGER) AS id, CAST({c} AS VARCHAR) AS values FROM "
    f"(SELECT * FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20)"
    for i, c in enumerate(_CUSTOMER)))
def unpivot_head20(spark, folder):
    return reshape.unpivot_cells(read(spark, folder, "customer"), 20, ["c_acctbal", "c_custkey"])


@query(_union(
    f"SELECT CAST({i} AS INTEGER) AS id, '{c}' AS columnname, count({c}) AS n_cells FROM orders"
    for i, (c, _) in enumerate(_ORDERS)))
def column_dictionary(spark, folder):
    """The column dictionary, with the number of cells of each column."""
    orders = read(spark, folder, "orders")
    counts = reshape.unpivot_cells(orders).groupBy("id").agg(F.count(F.lit(1)).alias("n_cells"))
    return reshape.column_dictionary(orders).join(counts, "id")


def _literal():
    """A record per event in the notation of a literal, broken for clicks."""
    kind = F.col("event_type")
    return F.concat(
        F.lit("{'kind': '"), kind, F.lit("', 'user': "), F.col("user_id").cast("string"),
        F.when(kind == "view", F.lit(", 'seen': True, 'note': None}"))
        .when(kind == "error", F.lit(", 'why': \"it's broken\"}"))
        .when(kind == "click", F.lit(", oops"))
        .otherwise(F.lit("}")),
    )


def _dump(spark, folder):
    events = read(spark, folder, "events")
    rows = events.select("event_id", F.lit("web").alias("db"), F.col("event_type").alias("tab"),
                         _literal().alias("rawdata"))
    return reshape.parse_records(rows, ["db", "tab"], "rawdata")


@query("""SELECT event_id, 'web.' || event_type AS filename, event_type AS kind,
    CAST(user_id AS VARCHAR) AS user, CASE WHEN event_type = 'view' THEN 'true' END AS seen,
    CASE WHEN event_type = 'error' THEN 'it''s broken' END AS why
FROM events WHERE event_type <> 'click'""")
def rebuild_records(spark, folder):
    records, _ = _dump(spark, folder)
    keys = ["kind", "user", "seen", "why"]
    return records.select("event_id", "filename", *[F.element_at("record", F.lit(k)).alias(k) for k in keys])


@query("""SELECT DISTINCT 'web.' || event_type AS filename, unnest(CASE event_type
    WHEN 'view' THEN ['kind', 'user', 'seen', 'note'] WHEN 'error' THEN ['kind', 'user', 'why']
    ELSE ['kind', 'user'] END) AS columnname FROM events WHERE event_type <> 'click'""")
def rebuild_columns(spark, folder):
    records, _ = _dump(spark, folder)
    return reshape.record_columns(records)


@query("""SELECT 'view' AS kind, CAST(user_id AS VARCHAR) AS user, 'true' AS seen,
    CAST(NULL AS VARCHAR) AS note FROM events WHERE event_type = 'view'""")
def rebuild_one_table(spark, folder):
    records, _ = _dump(spark, folder)
    return reshape.rebuild_table(records, "web.view", ["kind", "user", "seen", "note"])


@query("""SELECT 'web.' || event_type AS filename, CASE event_type WHEN 'view' THEN 'kind,note,seen,user'
        WHEN 'error' THEN 'kind,user,why' ELSE 'kind,user' END AS header,
    CASE event_type WHEN 'view' THEN event_type || ',,true,' || user_id
        WHEN 'error' THEN event_type || ',' || user_id || ',it''s broken'
        ELSE event_type || ',' || user_id END AS line, count(*) AS n
FROM events WHERE event_type <> 'click' GROUP BY ALL""")
def rebuild_files(spark, folder):
    """All tables of the dump written as CSV, and the lines of the files."""
    records, _ = _dump(spark, folder)
    path = fresh_path(spark, "rebuilt")
    reshape.write_tables(records, path, rows_per_file=2_000)
    lines = spark.read.schema("value STRING, filename STRING").text(path)
    header = F.col("value").startswith("kind,user") & F.col("value").isin("kind,user", "kind,user,why")
    header = header | (F.col("value") == "kind,note,seen,user")
    heads = lines.filter(header).groupBy("filename").agg(F.min("value").alias("header"))
    body = lines.filter(~header).groupBy("filename", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))
    return body.join(heads, "filename")


@query("SELECT event_id, 'web.click' AS filename FROM events WHERE event_type = 'click'")
def rebuild_quarantine(spark, folder):
    _, bad = _dump(spark, folder)
    return bad.select("event_id", "filename")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS bri, s_name AS name, 'supplier' AS datatype,
    s_nationkey AS retention, 'Metadata' AS metadatatype FROM supplier""")
def ingest_json_files(spark, folder):
    """Documents written as JSON, one per file, and read back with their defaults."""
    path = fresh_path(spark, "documents")
    documents = read(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("bri"), F.col("s_name").alias("name"),
        F.lit("supplier").alias("datatype"), F.col("s_nationkey").alias("retention"))
    files.write_documents(documents, path)
    found, _ = files.read_documents(spark, path)
    valid, _ = validate(found)
    return fill_defaults(valid).select("bri", "name", "datatype", "retention", "metadatatype")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def read_delimited(spark, folder):
    path = fresh_path(spark, "delimited")
    read(spark, folder, "customer").write.option("sep", ";").option("header", True).csv(path)
    return files.read_delimited(spark, path)
