"""Find entities in text by pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.patterns import PATTERNS, TOKEN_SPLIT, EntityPattern
from lakewarden.settings import spread


def _all_found(text: Column, patterns: Sequence[EntityPattern]) -> Column:
    """(number of the pattern, its matches) of all patterns; patterns with the same guard share one test of it."""
    by_guard: dict[str | None, list[tuple[int, EntityPattern]]] = {}
    for i, p in enumerate(patterns):
        by_guard.setdefault(p.guard, []).append((i, p))
    none = F.array().cast("array<struct<pattern:int,matches:array<string>>>")
    groups = []
    for guard, members in by_guard.items():
        found = F.array(*[F.struct(F.lit(i).alias("pattern"), p.search(text).alias("matches")) for i, p in members])
        groups.append(found if guard is None else F.when(text.rlike(guard), found).otherwise(none))
    return F.concat(*groups)


def _names(patterns: Sequence[EntityPattern]) -> Column:
    return F.get(F.array(*[F.lit(p.name) for p in patterns]), F.col("pattern")).alias("entity_type")


def _occurrences(df: DataFrame, id_column: str, text_column: str, patterns: Sequence[EntityPattern]) -> DataFrame:
    """(id, pattern, match), one row per occurrence; patterns go by number."""
    texts = spread(df.select(id_column, text_column).filter(F.col(text_column).isNotNull()))
    found = texts.select(id_column, F.explode(_all_found(F.col(text_column), patterns)).alias("_e"))
    return found.select(id_column, F.col("_e.pattern").alias("pattern"), F.explode("_e.matches").alias("match"))


def find_entities(
    df: DataFrame,
    id_column: str,
    text_column: str,
    patterns: Sequence[EntityPattern] | None = None,
) -> DataFrame:
    """(id, entity_type, match), one row per occurrence, in one pass over the texts.

    A small input is first spread over the cores.
    """
    patterns = PATTERNS if patterns is None else list(patterns)
    return _occurrences(df, id_column, text_column, patterns).select(id_column, _names(patterns), "match")


def detect_entities(
    df: DataFrame,
    id_column: str,
    text_column: str,
    patterns: Sequence[EntityPattern] | None = None,
) -> DataFrame:
    """(id, entity_type, match, n): how often each match occurs in each text."""
    patterns = PATTERNS if patterns is None else list(patterns)
    counted = (
        _occurrences(df, id_column, text_column, patterns)
        .groupBy(id_column, "pattern", "match")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(id_column, _names(patterns), "match", "n")


def has_entity(text: Column, pattern: EntityPattern) -> Column:
    """TRUE where the pattern occurs in the text."""
    return F.size(pattern.matches(text)) > 0


def split_tokens(text: Column) -> Column:
    """The text cut at blanks and at = : * ' " . |, empty parts included."""
    return F.split(text, TOKEN_SPLIT)
