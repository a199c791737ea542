"""Joins and ordered scans that stay balanced when one key holds much of the data.

* ``lookup_join`` joins rows to a lookup. It is broadcast if its counted size is within
  bounds; otherwise only its rows that belong to hot keys are, so hot rows are never
  shuffled by their key. If even those are too many, hot rows are salted.
* ``previous`` and ``numbered`` are window functions over (keys, order). Rows of hot keys
  are dealt by ranges of the key and all order columns; what a partition has of a key is
  an ordinary window, and one small row per partition carries the value to the next one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.settings import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    ROWS_PER_GROUP,
    work_dir,
)

# Ranges come from a sample, so partitions are planned smaller than the limit.
SLACK = 1.25
BLOCK = "_block"
UNSPLIT = -1


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Count the rows and bytes of a lookup and compare them with the bounds."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")
    ).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame | None:
    """Keys with more than ``rows_per_group`` rows, and their row counts, or None.

    There are at most (rows of df / rows_per_group) of them. The result is
    checkpointed, so that later uses do not count again.
    """
    if df.count() <= rows_per_group:
        return None
    work_dir(df.sparkSession)
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_group)
        .checkpoint()
    )
    return None if hot.isEmpty() else hot


def _same(keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return condition


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows_per_group: int = ROWS_PER_GROUP,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``left`` to ``right``, usually one row per key, but any number will do.

    ``how`` is left, inner, left_semi or left_anti. ``hot`` may name the hot keys of ``left`` (with their ``_rows``)
    if the caller has counted them already. The lookup is computed once: it is measured and joined from a checkpoint.
    """
    on = list(on)
    work_dir(left.sparkSession)
    right = right.checkpoint()
    if fits_broadcast(right, max_broadcast_rows):
        return left.join(F.broadcast(right), on, how)
    known = left.dropna(subset=on)
    if how in ("inner", "left_semi"):
        left = known
    if hot is None:
        hot = hot_keys(known, on, rows_per_group)
    if hot is None:
        hot = known.select(*on).limit(0).withColumn("_rows", F.lit(0))
    shares = hot.select(*on, F.greatest(F.ceil(F.col("_rows") / rows_per_group), F.lit(1)).cast("int").alias("_shares"))
    if not fits_broadcast(shares):
        # More hot keys than a broadcast may hold: adaptive skew-join splitting remains.
        return left.join(right, on, how)
    marked = left.join(F.broadcast(shares), on, "left")
    missing = F.lit(False)
    for k in on:
        missing = missing | F.col(k).isNull()
    is_hot = F.col("_shares").isNotNull()
    hot_right = right.join(F.broadcast(shares), on, "inner")
    moved = marked.filter(~is_hot & ~missing).drop("_shares").join(right, on, how)
    # Rows whose key is NULL match nothing and stay where they are.
    alone = marked.filter(missing).drop("_shares").join(F.broadcast(right.limit(0)), on, how)
    rows_of_hot = marked.filter(is_hot)
    if fits_broadcast(hot_right, max_broadcast_rows):
        kept = rows_of_hot.drop("_shares").join(F.broadcast(hot_right.drop("_shares")), on, how)
    else:
        # Rows of a hot key are dealt to as many shares as it needs, and its part of the lookup goes to each of them.
        dealt = rows_of_hot.withColumn("_share", F.pmod(F.monotonically_increasing_id(), "_shares").cast("int"))
        copies = hot_right.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
        kept = dealt.drop("_shares").join(copies.drop("_shares"), [*on, "_share"], how).drop("_share")
    return kept.unionByName(moved).unionByName(alone)


def _tie_breakers(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """One hash of the other columns, as far as they can be hashed: rows that are equal in ``used`` may then be
    dealt to several partitions. Nothing if there are none."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in used and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    return [F.xxhash64(*rest)] if rest else []


def split_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Add ``_block``, a number that rises with the order inside each key.

    Rows of hot keys are dealt by ranges of the keys and all order columns; a block is what one partition has of
    a key. Other keys have the one block UNSPLIT. If no key is hot the input is returned without the column.
    """
    keys = list(keys)
    hot = hot_keys(df, keys, rows_per_group)
    if hot is None:
        return df
    parts = math.ceil(hot.agg(F.sum("_rows")).first()[0] * SLACK / rows_per_group)
    lookup = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    lookup = F.broadcast(lookup) if fits_broadcast(lookup) else lookup
    ranges = [*keys, *[c for c in order if c not in keys]]
    dealt = (
        df.join(lookup, _same(keys, "_h_"), "left_semi")
        .repartitionByRange(parts, *ranges, *_tie_breakers(df, ranges))
        .withColumn(BLOCK, F.spark_partition_id())
        # Ranges follow from a sample: they are kept as they were dealt.
        .checkpoint()
    )
    rest = df.join(lookup, _same(keys, "_h_"), "left_anti").withColumn(BLOCK, F.lit(UNSPLIT))
    return dealt.unionByName(rest)


def _blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_group: int | None
):
    """(frame, keys, whether the keys were made up, whether blocks exist).

    With rows_per_group None the caller has called split_blocks already.
    """
    keys = list(keys)
    made_up = not keys
    if made_up:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    if rows_per_group is not None and BLOCK not in df.columns:
        df = split_blocks(df, keys, order, rows_per_group)
    return df, keys, made_up, BLOCK in df.columns


def _carry(
    summary: DataFrame, keys: Sequence[str], names: Sequence[str], aggregate
) -> DataFrame:
    """Per (key, block): the aggregate of each summary value over the earlier blocks."""
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.col(BLOCK).alias(f"_c_{BLOCK}"),
        *[aggregate(F.col(n)).over(earlier).alias(f"_c_{n}") for n in names],
    )


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    rows_per_group: int | None = ROWS_PER_GROUP,
    keep_blocks: bool = False,
) -> DataFrame:
    """Add, for each name in ``values``, the last non-NULL value on an earlier row."""
    df, keys, made_up, split = _blocks(df, keys, order, rows_per_group)
    for name, value in values.items():
        df = df.withColumn(f"_v_{name}", value)
    part = [*keys, BLOCK] if split else keys
    before = (
        Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    out = df
    for name in values:
        out = out.withColumn(name, F.last(f"_v_{name}", ignorenulls=True).over(before))
    if split:
        at = F.struct(*order)
        ends = df.filter(F.col(BLOCK) > UNSPLIT).groupBy(*part).agg(
            *[
                F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(n)
                for n in values
            ]
        )
        carry = _carry(ends, keys, list(values), lambda c: F.last(c, ignorenulls=True))
        out = out.join(carry, _same(part, "_c_"), "left")
        for name in values:
            out = out.withColumn(name, F.coalesce(name, f"_c_{name}"))
        out = out.drop(*[f"_c_{c}" for c in [*part, *values]])
    out = out.drop(*[f"_v_{n}" for n in values])
    if made_up:
        out = out.drop("_all")
    return out if keep_blocks else out.drop(BLOCK)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """Add the 1-based row number inside each key, in the given order."""
    df, keys, made_up, split = _blocks(df, keys, order, rows_per_group)
    part = [*keys, BLOCK] if split else keys
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    if split:
        sizes = df.filter(F.col(BLOCK) > UNSPLIT).groupBy(*part).agg(F.count(F.lit(1)).alias(name))
        carry = _carry(sizes, keys, [name], F.sum)
        out = out.join(carry, _same(part, "_c_"), "left")
        out = out.withColumn(
            name, (F.col(name) + F.coalesce(f"_c_{name}", F.lit(0))).cast("bigint")
        ).drop(*[f"_c_{c}" for c in [*part, name]])
    else:
        out = out.withColumn(name, F.col(name).cast("bigint"))
    out = out.drop(BLOCK)
    return out.drop("_all") if made_up else out
