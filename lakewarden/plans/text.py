"""Entity detection and tagging queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lakewarden.functions import patterns as P
from lakewarden.operators import tagging
from lakewarden.operators.entities import detect_entities, find_entities, split_tokens
from lakewarden.plans.catalogue import QUERIES, SQL, query, read

_BY_NAME = {p.name: p for p in P.PATTERNS}


def _texts(spark, folder):
    """The texts of documents, conversations, pages and benchmark items, and a note per order."""
    documents = read(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    conversations = read(spark, folder, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("."), "turn"), "text")
    pages = read(spark, folder, "pages").select(F.concat(F.lit("p"), "page_id"), "html")
    items = read(spark, folder, "benchmark").select(F.concat(F.lit("b"), "item_id"), "text")
    notes = read(spark, folder, "orders").select(
        F.concat(F.lit("o"), "o_orderkey"),
        F.format_string(
            "At 10:%02d pm call 415-555-%04d ext. %d; paint #%06x, zip %05d, P.O. Box %d, id: x%d, "
            "due 1/%d/2020, name: c%d, cost $%d.25, mail a%d@shop.example.org, ask @clerk_%d, from "
            "10.0.%d.1, see http://x%d.example.com/p . Kind regards, %s",
            F.expr("o_orderkey % 60"), F.expr("o_orderkey % 10000"), F.expr("o_custkey % 100"),
            F.expr("o_orderkey % 65536"), F.expr("o_custkey % 100000"), "o_custkey", "o_orderkey",
            F.expr("1 + o_orderkey % 12"), "o_custkey", F.expr("o_orderkey % 1000"), "o_custkey",
            F.expr("o_custkey % 10"), F.expr("o_orderkey % 256"), "o_custkey", "o_orderpriority",
        ),
    )
    return documents.union(conversations).union(pages).union(items).union(notes)


_TEXTS = """(SELECT 'd' || doc_id AS id, text FROM documents
    UNION ALL SELECT 'c' || conv_id || '.' || turn, text FROM conversations
    UNION ALL SELECT 'p' || page_id, html FROM pages
    UNION ALL SELECT 'b' || item_id, text FROM benchmark
    UNION ALL SELECT 'o' || o_orderkey, printf('At 10:%02d pm call 415-555-%04d ext. %d; paint #%06x, '
        'zip %05d, P.O. Box %d, id: x%d, due 1/%d/2020, name: c%d, cost $%d.25, mail a%d@shop.example.org, '
        'ask @clerk_%d, from 10.0.%d.1, see http://x%d.example.com/p . Kind regards, %s',
        o_orderkey % 60, o_orderkey % 10000, o_custkey % 100, o_orderkey % 65536, o_custkey % 100000,
        o_custkey, o_orderkey, 1 + o_orderkey % 12, o_custkey, o_orderkey % 1000, o_custkey,
        o_custkey % 10, o_orderkey % 256, o_custkey, o_orderpriority) FROM orders)"""


def _pattern_sql(pattern) -> str:
    """The pattern without its JVM flags, for an engine without look-around."""
    regex, group = (pattern.plain, 0) if pattern.plain else (pattern.regex, pattern.group)
    head = re.match(r"\(\?([a-zA-Z]+)\)", regex)
    body = regex[head.end():] if head else regex
    flags = "(?i)" if head and "i" in head[1] else ""
    quoted = (flags + body).replace("'", "''")
    return f"""SELECT id, '{pattern.name}' AS entity_type, match, count(*) AS n FROM (
        SELECT id, unnest(regexp_extract_all(text, '{quoted}', {group})) AS match
        FROM {_TEXTS}) GROUP BY id, match"""


# The patterns without look-around.
_PLAIN = [
    "time", "phone_with_extension", "email", "ip", "price", "hex_color", "zip_code", "po_box",
    "mention", "mixed_id", "explicit_id", "number", "simple_email", "domain", "url", "salutation",
    "clock", "numeric_date", "loose_ip", "named",
]


def _detector(name):
    def run(spark, folder):
        return detect_entities(_texts(spark, folder), "id", "text", [_BY_NAME[name]])

    return run


for _name in _PLAIN:
    QUERIES[f"detect_{_name}"] = _detector(_name)
    SQL[f"detect_{_name}"] = _pattern_sql(_BY_NAME[_name])


# Texts by order number, and by construction what they hold: (text, pattern, match, how often). {n} is a number of
# four digits, {h} and {s} its first two and three digits, {t} its last two.
_ALL_TEXTS = [
    "mail clerk{n}@shop.example.com or see http://shop{n}.example.com/a?b=1 soon",
    "on 12 May 2021 at 10:45 pm, 3/4/2020; name: c{n}, id: k{n}",
    "call (415) 555-{n} or 415-555-{n} ext. 12",
    "hosts 10.0.3.1 and 2001:db8:0:0:0:0:1:{n} are up",
    "pay 1a2b3a2b3a2b3a2b3a2b3a2b3a2b3 or ${n}.25, painted #ff00aa",
    "card 4111-{n}-{n}-1111, number 123-45-{n}, clerk @clerk_{n}",
    "{n} Long Street office, zip 94110-{n}, P.O. Box {n}",
    "www.shop{n}.example.org/x kind regards, Ann{n}",
    "nothing to see here",
]
_ALL_MATCHES = [
    (0, 'domain', 'shop.example.com', 1),
    (0, 'domain', 'shop{n}.example.com', 1),
    (0, 'email', 'clerk{n}@shop.example.com', 1),
    (0, 'link', 'http://shop{n}.example.com/a?b=1', 1),
    (0, 'link', 'shop.example.com', 1),
    (0, 'mention', '@shop', 1),
    (0, 'mixed_id', 'clerk{n}', 1),
    (0, 'mixed_id', 'shop{n}', 1),
    (0, 'number', '{n}', 2),
    (0, 'simple_email', 'clerk{n}@shop.example.com', 1),
    (0, 'url', 'http://shop{n}.example.com/a?b=1', 1),
    (1, 'clock', '10:45 pm', 1),
    (1, 'date', '12 May 2021', 1),
    (1, 'date', '3/4/2020', 1),
    (1, 'explicit_id', 'k{n}', 1),
    (1, 'mixed_id', 'c{n}', 1),
    (1, 'mixed_id', 'k{n}', 1),
    (1, 'named', 'c{n}', 1),
    (1, 'number', '2020', 1),
    (1, 'number', '2021', 1),
    (1, 'number', '{n}', 2),
    (1, 'numeric_date', '3/4/2020', 1),
    (1, 'time', '10:45 pm', 1),
    (2, 'number', '415) 555-{n}', 1),
    (2, 'number', '415-555-{n}', 1),
    (2, 'phone', '(415) 555-{n}', 1),
    (2, 'phone', '415-555-{n}', 1),
    (2, 'phone_with_extension', '415-555-{n} ext. 12', 1),
    (3, 'clock', '0:0:1', 1),
    (3, 'clock', '10.0.3', 1),
    (3, 'clock', '8:0:0', 1),
    (3, 'ip', '10.0.3.1', 1),
    (3, 'ipv6', '2001:db8:0:0:0:0:1:{n}', 1),
    (3, 'loose_ip', '10.0.3.1', 1),
    (3, 'mixed_id', 'db8', 1),
    (3, 'number', '10.0.3.1', 1),
    (3, 'number', '2001', 1),
    (3, 'number', '{n}', 1),
    (3, 'time', '1:{h}', 1),
    (4, 'btc_address', '1a2b3a2b3a2b3a2b3a2b3a2b3a2b3', 1),
    (4, 'clock', '{t}.25', 1),
    (4, 'hex_color', '#ff00aa', 1),
    (4, 'mixed_id', '1a2b3a2b3a2b3a2b3a2b3a2b3a2b3', 1),
    (4, 'mixed_id', 'ff00aa', 1),
    (4, 'number', '{n}.25', 1),
    (4, 'price', '${s}', 1),
    (5, 'credit_card', '4111-{n}-{n}-1111', 1),
    (5, 'mention', '@clerk_{n}', 1),
    (5, 'mixed_id', 'clerk_{n}', 1),
    (5, 'number', '123-45-{n}', 1),
    (5, 'number', '4111-{n}-{n}-1111', 1),
    (5, 'number', '{n}', 1),
    (5, 'numeric_date', '23-45-{n}', 1),
    (5, 'ssn', '123-45-{n}', 1),
    (6, 'number', '94110-{n}', 1),
    (6, 'number', '{n}', 2),
    (6, 'phone', '94110-{n}', 1),
    (6, 'po_box', 'P.O. Box {n}', 1),
    (6, 'street_address', '{n} Long Street', 1),
    (6, 'zip_code', '94110-{n}', 1),
    (7, 'domain', 'www.shop{n}.example.org', 1),
    (7, 'link', 'www.shop{n}.example.org', 1),
    (7, 'mixed_id', 'Ann{n}', 1),
    (7, 'mixed_id', 'shop{n}', 1),
    (7, 'number', '{n}', 2),
    (7, 'salutation', 'regards, Ann{n}', 1),
    (7, 'url', 'www.shop{n}.example.org/x', 1),
]
_NUMBER = "CAST(1000 + o_orderkey % 9000 AS VARCHAR)"


def _filled(pattern: str) -> str:
    for part, value in (("{n}", "x.n"), ("{h}", "x.n[1:2]"), ("{s}", "x.n[1:3]"), ("{t}", "x.n[3:4]")):
        pattern = f"replace({pattern}, '{part}', {value})"
    return pattern


@query(f"""SELECT x.id, m.entity_type, {_filled('m.match')} AS match, m.n
    FROM (SELECT o_orderkey AS id, o_orderkey % {len(_ALL_TEXTS)} AS kind, {_NUMBER} AS n FROM orders) x
    JOIN (VALUES {', '.join(map(str, _ALL_MATCHES))}) m(kind, entity_type, match, n) USING (kind)""")
def detect_built(spark, folder):
    """Every pattern, look-around and links included, in one pass over texts that are built to hold each of them."""
    texts = F.array(*[F.lit(t) for t in _ALL_TEXTS])
    kind = F.expr(f"CAST(o_orderkey % {len(_ALL_TEXTS)} AS INT)")
    number = F.expr("CAST(1000 + o_orderkey % 9000 AS STRING)")
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.replace(F.get(texts, kind), F.lit("{n}"), number).alias("text"))
    return detect_entities(orders, "id", "text")


@query()
def detect_all(spark, folder):
    """Every pattern in one pass over all texts. The engine of the SQL knows no look-around; the test compares with
    Python."""
    return detect_entities(_texts(spark, folder), "id", "text")


@query(rf"""SELECT id, len(tokens) AS n_tokens, len(list_filter(tokens, lambda t: t = '')) AS n_empty,
    tokens[1] AS first_token, tokens[-1] AS last_token
    FROM (SELECT id, regexp_split_to_array(text, '\s|=|:|\*|''|"|\.|\|') AS tokens FROM {_TEXTS})""")
def split_texts(spark, folder):
    tokens = _texts(spark, folder).select("id", split_tokens(F.col("text")).alias("tokens"))
    return tokens.select(
        "id", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.filter("tokens", lambda t: t == "")).cast("bigint").alias("n_empty"),
        F.element_at("tokens", 1).alias("first_token"),
        F.element_at("tokens", -1).alias("last_token"),
    )


def _in_orders(name, text, expected):
    """A pattern on texts made from orders, where the matches are known by construction.

    ``text`` is an expression and ``expected`` an SQL expression for the match, NULL where
    there is none.
    """

    def run(spark, folder):
        pattern = {
            "greeting": lambda: P.greeting_pattern(r"\b(?:hello|dear) \w+"),
        }.get(name, lambda: _BY_NAME[name])()
        orders = read(spark, folder, "orders").select("o_orderkey", F.expr(text).alias("text"))
        return find_entities(orders, "o_orderkey", "text", [pattern])

    QUERIES[f"detect_{name}"] = run
    SQL[f"detect_{name}"] = f"""SELECT o_orderkey, '{name}' AS entity_type, match
        FROM (SELECT o_orderkey, {expected} AS match FROM orders) WHERE match IS NOT NULL"""


_in_orders(
    "ssn",
    "format_string('no %03d-%02d-%04d.', o_orderkey % 1000, o_custkey % 100, o_orderkey % 10000)",
    "CASE WHEN o_orderkey % 1000 <= 772 AND o_orderkey % 1000 NOT IN (0, 333, 666) "
    "AND o_custkey % 100 <> 0 AND o_orderkey % 10000 <> 0 "
    "THEN printf('%03d-%02d-%04d', o_orderkey % 1000, o_custkey % 100, o_orderkey % 10000) END",
)
_in_orders(
    "credit_card",
    "format_string(if(o_orderstatus = 'F', 'card 4111-%04d-%04d-1111 x', 'card 4111 %04d %04d 111x'), "
    "o_orderkey % 10000, o_custkey % 10000)",
    "CASE WHEN o_orderstatus = 'F' THEN printf('4111-%04d-%04d-1111', o_orderkey % 10000, "
    "o_custkey % 10000) END",
)
_in_orders(
    "phone",
    "format_string(if(o_orderstatus = 'P', 'call 415-555-%04d0 now', 'call (415) 555-%04d now'), "
    "o_orderkey % 10000)",
    "CASE WHEN o_orderstatus <> 'P' THEN printf('(415) 555-%04d', o_orderkey % 10000) END",
)
_in_orders(
    "date",
    "concat('due ', date_format(o_orderdate, if(o_orderstatus = 'F', 'dd MMM yyyy', 'dd/MM/yyyy')), ';')",
    "CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d %b %Y') "
    "ELSE strftime(o_orderdate, '%d/%m/%Y') END",
)
_in_orders(
    "ipv6",
    "concat('host 2001:db8:0:0:0:0:1:', lower(hex(o_orderkey % 65536)), if(o_orderstatus = 'F', ' up', ''))",
    "'2001:db8:0:0:0:0:1:' || lower(to_hex(o_orderkey % 65536))",
)
_in_orders(
    "street_address",
    "concat(o_orderkey % 10000, ' Priority ', if(o_orderstatus = 'F', 'Street', 'Stream'), ' office')",
    "CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 10000) || ' Priority Street' END",
)
_in_orders(
    "btc_address",
    "concat('pay 1', left(replace(sha2(cast(o_orderkey as string), 256), '0', 'z'), "
    "if(o_orderstatus = 'F', 30, 40)), ' now')",
    "CASE WHEN o_orderstatus = 'F' THEN '1' || left(replace(sha256(CAST(o_orderkey AS VARCHAR)), '0', 'z'), 30) END",
)
_in_orders(
    "link",
    "concat('see http://shop', o_custkey, if(o_orderstatus = 'F', '.example.com/a?b=', '.local.qq/a?b='), "
    "o_orderkey, '. end')",
    "CASE WHEN o_orderstatus = 'F' THEN 'http://shop' || o_custkey || '.example.com/a?b=' || o_orderkey END",
)
_in_orders(
    "greeting",
    "concat(if(o_orderstatus = 'F', 'Hello ', 'Yellow '), 'client', o_custkey, ', goods')",
    "CASE WHEN o_orderstatus = 'F' THEN 'Hello client' || o_custkey END",
)


def _places(spark, folder):
    """Customers with a place: their nation, region or segment, in changing case."""
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    place = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("n_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit(" "), "r_name"))
        .otherwise(F.col("c_mktsegment"))
    )
    return (
        read(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", place.alias("place"))
    )


def _gazetteer(spark, folder):
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    segments = read(spark, folder, "customer").select(F.lower("c_mktsegment").alias("term")).distinct()
    return (
        nation.select(F.col("n_name").alias("term"), F.lit("country").alias("label"))
        .union(nation.select("n_name", F.lit("place")))
        .union(region.select("r_name", F.lit("region")))
        .union(region.select("r_name", F.lit("place")))
        .union(segments.select("term", F.lit("place")))
    )


@query("""SELECT c_custkey, c_mktsegment = 'BUILDING' AS is_country, c_mktsegment = 'MACHINERY' AS is_region,
    true AS is_place FROM customer""")
def tag_country(spark, folder):
    labels = {"is_country": "country", "is_region": "region", "is_place": "place"}
    return tagging.tag_values(_places(spark, folder), "place", _gazetteer(spark, folder), labels).drop(
        "c_name", "place")


@query("SELECT c_custkey, c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS is_city FROM customer")
def tag_city(spark, folder):
    return tagging.tag_cities(_places(spark, folder), "place", _gazetteer(spark, folder)).drop("c_name", "place")


@query("""WITH t AS (SELECT count(*) AS n, count(*) FILTER (c_mktsegment = 'BUILDING') AS c,
        count(*) FILTER (c_mktsegment = 'MACHINERY') AS r FROM customer)
    SELECT 'place' AS columnname, 'place' AS tag, n AS n_values, n AS n_hits, CAST(1 AS DOUBLE) AS share FROM t
    UNION ALL SELECT 'place', 'country', n, c, round(CAST(c AS DOUBLE) / n, 9) FROM t WHERE c / n >= 0.15
    UNION ALL SELECT 'place', 'region', n, r, round(CAST(r AS DOUBLE) / n, 9) FROM t WHERE r / n >= 0.15
    UNION ALL SELECT 'c_name', 'number', n, n, 1 FROM t""")
def tag_columns(spark, folder):
    df = _places(spark, folder).select("c_name", "place")
    tagged = tagging.tag_columns(df, _gazetteer(spark, folder), [_BY_NAME["number"], _BY_NAME["email"]], 0.15)
    return tagged.withColumn("share", F.round("share", 9))


@query("""SELECT id, spans[1] AS "begin", spans[2] AS "end", label FROM (
    SELECT c_custkey AS id, label, [CAST(strpos(t, term) - 1 AS INTEGER),
        CAST(strpos(t, term) - 1 + length(term) AS INTEGER)] AS spans
    FROM (SELECT *, c_name || ' of ' || n_name || ', ' || c_mktsegment AS t
          FROM customer JOIN nation ON c_nationkey = n_nationkey) CROSS JOIN LATERAL (
        SELECT n_name AS term, 'country' AS label UNION ALL SELECT c_mktsegment, 'segment'))""")
def annotate_spans(spark, folder):
    nation = read(spark, folder, "nation")
    customer = read(spark, folder, "customer")
    texts = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit(" of "), "n_name", F.lit(", "), "c_mktsegment").alias("text"))
    terms = nation.select(F.col("n_name").alias("term"), F.lit("country").alias("label")).union(
        customer.select("c_mktsegment", F.lit("segment")).distinct())
    spans = tagging.annotate_spans(texts, "id", "text", terms)
    return spans.select("id", F.explode("entities").alias("e")).select("id", "e.*")


@query("""SELECT id, "begin", "end", label FROM (
    SELECT o_orderkey AS id, CAST(6 AS INTEGER) AS "begin", CAST(6 + length(c_name) AS INTEGER) AS "end",
        'customer' AS label FROM orders JOIN customer ON o_custkey = c_custkey)""")
def annotate_orders(spark, folder):
    """A gazetteer that grows with the customers, joined by word sequence."""
    customer = read(spark, folder, "customer")
    texts = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.format_string("paid: Customer#%09d, o_custkey", "o_custkey").alias("text"))
    terms = customer.select(F.col("c_name").alias("term"), F.lit("customer").alias("label"))
    spans = tagging.annotate_spans(texts, "id", "text", terms)
    return spans.select("id", F.explode("entities").alias("e")).select("id", "e.*")


@query("""SELECT DISTINCT c_name AS content, CAST(0 AS INTEGER) AS "begin", CAST(length(c_name) AS INTEGER) AS "end",
    c_mktsegment AS label FROM customer""")
def annotate_whole_terms(spark, folder):
    terms = read(spark, folder, "customer").select(
        F.col("c_name").alias("term"), F.col("c_mktsegment").alias("label"))
    spans = tagging.annotate_terms(terms)
    return spans.select("content", F.explode("entities").alias("e")).select("content", "e.*")
