"""Gazetteer lookups: tag values and columns, and annotate spans of text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.binding import let
from lakewarden.functions.patterns import EntityPattern
from lakewarden.operators.reshape import column_dictionary, unpivot_cells
from lakewarden.operators.skew import lookup_join
from lakewarden.settings import ROWS_PER_GROUP

# A gazetteer up to this size is matched inside each row, without a shuffle.
FEW_TERMS = 200


def normal(value: Column) -> Column:
    """The form in which values and terms are compared."""
    return F.lower(F.trim(value))


def capitalized(value: Column) -> Column:
    """The first letter as a capital, all others small."""
    return F.concat(F.upper(F.left(value, F.lit(1))), F.lower(F.substr(value, F.lit(2))))


def labels_by_term(gazetteer: DataFrame) -> DataFrame:
    """(term, labels): one row per normalised term of a (term, label) gazetteer."""
    return (
        gazetteer.select(normal(F.col("term")).alias("term"), "label")
        .dropna()
        .groupBy("term")
        .agg(F.sort_array(F.collect_set("label")).alias("labels"))
    )


def tag_values(
    df: DataFrame,
    column: str,
    gazetteer: DataFrame,
    labels: Mapping[str, str],
    rows_per_group: int = ROWS_PER_GROUP,
    **limits,
) -> DataFrame:
    """Add a boolean column per entry of ``labels`` (new column -> gazetteer label).

    It is TRUE if the value is, in any case, a term of that label; FALSE for NULL.
    """
    lookup = labels_by_term(gazetteer).select(
        F.col("term").alias("_term"), F.col("labels").alias("_labels")
    )
    keyed = df.withColumn("_term", normal(F.col(column)))
    out = lookup_join(keyed, lookup, ["_term"], "left", rows_per_group=rows_per_group, **limits)
    for name, label in labels.items():
        hit = F.coalesce(F.array_contains("_labels", label), F.lit(False))
        out = out.withColumn(name, hit)
    return out.select(*df.columns, *labels)


def tag_cities(
    df: DataFrame, column: str, gazetteer: DataFrame, name: str = "is_city", **limits
) -> DataFrame:
    """A city is a place that is neither a country nor a region."""
    flags = {"_place": "place", "_country": "country", "_region": "region"}
    tagged = tag_values(df, column, gazetteer, flags, **limits)
    city = F.col("_place") & ~F.col("_country") & ~F.col("_region")
    return tagged.withColumn(name, city).drop(*flags)


def tag_columns(
    df: DataFrame,
    gazetteer: DataFrame,
    patterns: Sequence[EntityPattern] = (),
    threshold: float = 0.5,
    rows_per_group: int = ROWS_PER_GROUP,
    **limits,
) -> DataFrame:
    """(columnname, tag, n_values, n_hits, share) of the tags that fit enough values.

    A value hits a label if it is one of its terms, and a pattern if it holds a match.
    The counts are combined on each task before the shuffle.
    """
    cells = unpivot_cells(df).withColumn("_term", normal(F.col("values")))
    lookup = labels_by_term(gazetteer).select(
        F.col("term").alias("_term"), F.col("labels").alias("_labels")
    )
    cells = lookup_join(cells, lookup, ["_term"], "left", rows_per_group=rows_per_group, **limits)
    found = [
        F.when(F.size(p.matches(F.col("values"))) > 0, F.lit(p.name)) for p in patterns
    ]
    hits = F.array_compact(F.array(F.lit("*"), *found))
    tags = F.concat(hits, F.coalesce("_labels", F.array().cast("array<string>")))
    counts = (
        cells.select("id", F.explode(F.array_distinct(tags)).alias("tag"))
        .groupBy("id", "tag")
        .agg(F.count(F.lit(1)).alias("n_hits"))
    )
    totals = counts.filter("tag = '*'").select("id", F.col("n_hits").alias("n_values"))
    # Both sides have at most (columns x tags) rows.
    return (
        counts.filter("tag <> '*'")
        .join(totals, "id")
        .join(column_dictionary(df), "id")
        .withColumn("share", F.col("n_hits") / F.col("n_values"))
        .filter(F.col("share") >= threshold)
        .select("columnname", "tag", "n_values", "n_hits", "share")
    )


ENTITIES = "array<struct<begin:int,end:int,label:string>>"


def annotate_terms(gazetteer: DataFrame) -> DataFrame:
    """(content, entities): each term as a text whose one entity is the whole of it."""
    term = F.col("term")
    whole = F.struct(
        F.lit(0).alias("begin"), F.char_length(term).alias("end"), F.col("label").alias("label")
    )
    entities = F.when(F.char_length(term) > 0, F.array(whole)).otherwise(F.array())
    return gazetteer.select(term.alias("content"), entities.cast(ENTITIES).alias("entities"))


def _occurrences(text: Column, term: Column, label: Column) -> Column:
    """Spans of the term in the text where it is not part of a longer word."""
    edge = r"[\p{L}\p{N}]"
    quoted = F.concat(
        F.lit(rf"(?<!{edge})\Q"),
        F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")),
        F.lit(rf"\E(?!{edge})"),
    )

    def spans(gaps: Column) -> Column:
        def span(i: Column) -> Column:
            before = F.aggregate(
                F.slice(gaps, F.lit(1), i), F.lit(0), lambda total, gap: total + F.char_length(gap)
            )
            begin = before + (i - 1) * F.char_length(term)
            return F.struct(
                begin.cast("int").alias("begin"),
                (begin + F.char_length(term)).cast("int").alias("end"),
                label.alias("label"),
            )

        several = F.transform(F.sequence(F.lit(1), F.size(gaps) - 1), span).cast(ENTITIES)
        return F.when(F.size(gaps) > 1, several).otherwise(F.array().cast(ENTITIES))

    return let(F.split(text, quoted), spans)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _marks(text: Column) -> Column:
    """The distinct words of a text, and the distinct other characters."""
    words = F.concat(_words(text), F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}]"), F.lit(0)))
    return F.array_distinct(words)


def _keys(term: Column) -> Column:
    """Marks that every text with the term has: its words, or its characters if it has none."""
    return let(_words(term), lambda words: F.when(F.size(words) > 0, F.array_distinct(words)).otherwise(_marks(term)))


def _candidates(texts: DataFrame, terms: DataFrame, rows_per_group: int, **limits) -> DataFrame:
    """(_id, _terms): for each text the terms whose anchor it holds.

    The anchor of a term is its word that occurs in the fewest texts. So a text meets a term only if it has the
    rarest word of it, and a term with a word that no text has meets none.
    """
    words = terms.select("term", F.explode(_keys(F.col("term"))).alias("_mark"))
    held = lookup_join(
        texts.select(F.col(texts.columns[0]).alias("_id"), F.explode(_marks(F.col("content"))).alias("_mark")),
        words.select("_mark").distinct(),
        ["_mark"],
        "left_semi",
        rows_per_group=rows_per_group,
        **limits,
    ).checkpoint()
    spread = held.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n"))
    # Both sides have a row per word of the gazetteer, the left one per term and word.
    known = words.join(spread, "_mark", "left")
    anchors = known.groupBy("term").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_mark").alias("_mark"))).alias("a")
    )
    anchored = terms.join(anchors.filter("a.n > 0").select("term", "a._mark"), "term")
    found = lookup_join(held, anchored, ["_mark"], "inner", rows_per_group=rows_per_group, **limits)
    return found.groupBy("_id").agg(F.collect_list(F.struct("term", "label")).alias("_terms"))


def annotate_spans(
    df: DataFrame,
    id_column: str,
    text_column: str,
    gazetteer: DataFrame,
    few_terms: int = FEW_TERMS,
    rows_per_group: int = ROWS_PER_GROUP,
    **limits,
) -> DataFrame:
    """(id, content, entities): the spans of gazetteer terms in each text, ends exclusive.

    A small gazetteer is matched inside each row. A larger one is an index of terms by their rarest word; only
    texts with that word are searched for the term. The ids must be unique.
    """
    terms = gazetteer.select("term", "label").dropna().filter("term <> ''").distinct()
    texts = df.select(F.col(id_column), F.col(text_column).alias("content"))
    content = F.col("content")
    listed = terms.limit(few_terms + 1).collect()
    if len(listed) <= few_terms:
        pairs = F.array(
            *[F.struct(F.lit(r["term"]).alias("term"), F.lit(r["label"]).alias("label"))
              for r in listed]
        ).cast("array<struct<term:string,label:string>>")
        joined = texts.withColumn(
            "_terms", F.filter(pairs, lambda p: F.contains(content, p["term"]))
        )
    else:
        candidates = _candidates(texts, terms, rows_per_group, **limits)
        joined = texts.join(candidates, F.col(id_column).eqNullSafe(F.col("_id")), "left").withColumn(
            "_terms", F.filter("_terms", lambda p: F.contains(content, p["term"]))
        )
    spans = F.flatten(
        F.transform("_terms", lambda p: _occurrences(content, p["term"], p["label"]))
    )
    entities = F.when(content.isNotNull(), F.sort_array(F.coalesce(spans, F.array().cast(ENTITIES))))
    return joined.select(id_column, "content", entities.alias("entities"))
