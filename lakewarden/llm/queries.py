"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import (
    decontamination,
    filter_audit,
    language_model,
    licenses,
    merkle,
    mixing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    simhash,
    token_counts,
    toxicity,
)
from lakewarden.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies of every document."""
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op10_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that every document holds."""
    return decontamination.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op6_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document."""
    return quality_model.score_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    return mixing.mix_documents(read(spark, folder, "documents"))


@query
def op5_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.shard_documents(read(spark, folder, "documents"))


@query
def op9_robust_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics of every document, and whether it is kept."""
    return quality_rules.judge(read(spark, folder, "documents"))


@query
def op3_log_bilinear_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The log-probability of every document."""
    return language_model.score_documents(read(spark, folder, "documents"))


@query
def op7_token_length_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of all documents for every context limit."""
    return token_counts.length_totals(read(spark, folder, "documents"))


@query
def op2_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    """The license notices in every document."""
    return licenses.scan(read(spark, folder, "documents"))


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in every document, with the candidates that are none."""
    return secrets.scan(read(spark, folder, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, root and proof of every document, and whether its row, tampered with or not, still leads to the root."""
    return merkle.manifest(read(spark, folder, "documents"))


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_encoded, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE rows AS (
    SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        xor(4294967295, list_reduce(
            list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::UBIGINT),
            lambda c, b: list_reduce([xor(c, b), 0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
                lambda d, i: xor(d // 2, 3988292384 * (d % 2))), 4294967295::UBIGINT)) % 3 = 0 AS hit
    FROM documents),
leaves AS (SELECT lang, doc_id, {_leaf("text")} AS leaf, CASE WHEN hit THEN {_leaf("low")} ELSE {_leaf("text")} END AS claimed
    FROM rows),
placed AS (SELECT *, count(*) OVER own AS n,
        row_number() OVER (own ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves WINDOW own AS (PARTITION BY lang)),
up AS (SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM placed
    UNION ALL
    SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1
    GROUP BY lang, lvl, pos // 8, n),
tops AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM up WHERE n = 1),
over_all AS (SELECT 0 AS lvl, pos, n, h FROM tops
    UNION ALL
    SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM over_all WHERE n > 1
    GROUP BY lvl, pos // 8, n),
steps AS (SELECT lang, lvl, pos,
        coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM up WHERE n > 1 WINDOW run AS (PARTITION BY lang, lvl, pos // 8)),
top_steps AS (SELECT lvl, pos,
        coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM over_all WHERE n > 1 WINDOW run AS (PARTITION BY lvl, pos // 8)),
chain AS (SELECT lang, pos AS start, n, 0 AS lvl, pos, claimed AS h, '' AS proof FROM placed
    UNION ALL
    SELECT c.lang, start, (n + 7) // 8, c.lvl + 1, c.pos // 8, sha256(s.l || c.h || s.r), proof || s.l || s.r
    FROM chain c JOIN steps s ON s.lang IS NOT DISTINCT FROM c.lang AND s.lvl = c.lvl AND s.pos = c.pos),
whole AS (SELECT c.lang, start, t.n, 0 AS lvl, t.pos, c.h, proof
    FROM chain c JOIN tops t ON c.lang IS NOT DISTINCT FROM t.lang WHERE c.n = 1
    UNION ALL
    SELECT c.lang, start, (n + 7) // 8, c.lvl + 1, c.pos // 8, sha256(s.l || c.h || s.r), proof || s.l || s.r
    FROM whole c JOIN top_steps s ON s.lvl = c.lvl AND s.pos = c.pos)
SELECT p.doc_id, p.leaf, t.h AS subroot, o.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root,
    w.h = o.h AS verified
FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang
    JOIN whole w ON w.lang IS NOT DISTINCT FROM p.lang AND w.start = p.pos AND w.n = 1
    JOIN over_all o ON o.n = 1"""


@query
def op13_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove, at every place of all their orders, per language."""
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


SQL["op13_filter_interactions"] = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
marks AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic
    FROM labels GROUP BY doc_id),
failed AS (SELECT w.part, count(*) AS n, count(m.good) AS good, count(m.toxic) AS toxic,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END ||
        CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END ||
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END ||
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END ||
        CASE WHEN first < w.doc_id THEN 'E' ELSE '' END AS fails
    FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM words) w LEFT JOIN marks m USING (doc_id)
    GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS above
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
cases AS (SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS here,
        above <> '' AND regexp_matches(fails, '[' || above || '-]') AS gone
    FROM failed, steps),
counted AS (SELECT part, filter_order, step::INT AS step, x,
        coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (here AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (here AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM cases GROUP BY part, filter_order, step, x)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM counted"""


@query
def op12_toxic_passages(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.score_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))
