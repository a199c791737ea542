"""Lineage edges, and what lies downstream of an entity."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakewarden.operators.skew import fits_broadcast, hot_keys, lookup_join, numbered
from lakewarden.settings import ROWS_PER_GROUP, fresh_path, work_dir

EDGE = ["id", "input_bri", "output_bri", "movement_type", "relationship_level"]


def add_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Append edges (without id); ids continue after the largest one."""
    top = edges.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    ordered = numbered(new, [], ["input_bri", "output_bri"], "id")
    dtype = edges.schema["id"].dataType
    return edges.unionByName(ordered.withColumn("id", (F.col("id") + top).cast(dtype)).select(*EDGE))


def delete_edges(edges: DataFrame, ids: DataFrame, **limits) -> DataFrame:
    """Edges whose id is not in ``ids`` (id)."""
    return lookup_join(edges, ids.select("id").dropna().distinct(), ["id"], "left_anti", **limits)


class StoredEdges:
    """Edges in a table that is bucketed by their input: a walk moves its frontier to them, never the edges.

    Edges of nodes with more than ``rows_per_group`` of them are kept apart, spread over all files, so no bucket is
    large; their nodes are few.
    """

    def __init__(self, edges: DataFrame, rows_per_group: int = ROWS_PER_GROUP, **limits):
        self.rows_per_group, self.limits = rows_per_group, limits
        spark = edges.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.hot = hot_keys(edges, ["input_bri"], rows_per_group)
        self.of_hot = None
        if self.hot is not None:
            nodes = self.hot.select("input_bri")
            nodes = F.broadcast(nodes) if fits_broadcast(nodes) else nodes
            path = fresh_path(spark, "hot-edges")
            edges.join(nodes, "input_bri", "left_semi").select(*EDGE).write.parquet(path)
            self.of_hot = spark.read.schema(edges.select(*EDGE).schema).parquet(path)
            edges = edges.join(nodes, "input_bri", "left_anti").select(*EDGE)
        name = f"lineage_{uuid.uuid4().hex}"
        dealt = edges.repartition(parts, "input_bri").write.bucketBy(parts, "input_bri").sortBy("input_bri")
        dealt.option("path", fresh_path(spark, name)).saveAsTable(name)
        self.bucketed = spark.table(name)
        # The files stay in the shared folder; only the name goes.
        spark.sql(f"DROP TABLE {name}")

    def leaving(self, frontier: DataFrame, how: str = "inner") -> DataFrame:
        """The edges that leave the nodes of ``frontier`` (input_bri, ...), with its other columns if ``how`` is inner."""
        out = self.bucketed.join(frontier, "input_bri", how)
        if self.of_hot is None:
            return out
        more = lookup_join(
            self.of_hot, frontier, ["input_bri"], how, rows_per_group=self.rows_per_group, hot=self.hot, **self.limits
        )
        return out.unionByName(more)


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """A checkpoint of the frame and its number of rows, by one pass."""
    seen = Observation()
    done = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint()
    return done, seen.get["n"]


def downstream(
    edges: DataFrame,
    start: str | Sequence[str] | DataFrame,
    max_depth: int | None = None,
    distinct_edges: bool = False,
    rows_per_group: int = ROWS_PER_GROUP,
    **limits,
) -> DataFrame:
    """Edges downstream of the start entities, level 0 at the entities themselves.

    One row per path: an edge reached by two ways is given twice, with ``path``, the entities
    passed. An edge back to an entity on its own path is neither given nor followed. With
    ``distinct_edges`` each edge is given once, at the smallest level, and work is linear in
    the edges however many paths there are; use it for wide graphs.

    Each level joins the frontier to the stored edges, checkpointed so that plans do not grow with the
    depth. The walk ends when nothing new is reached. With ``max_depth`` it ends after so many levels,
    and ``cut_off`` says in every row whether edges remain beyond them.
    """
    spark = edges.sparkSession
    work_dir(spark)
    if isinstance(start, str):
        start = [start]
    if not isinstance(start, DataFrame):
        rows = F.array(*[F.lit(s) for s in start]).cast("array<string>")
        start = spark.range(1).select(F.explode(rows).alias("bri"))
    stored = StoredEdges(edges.select(*EDGE), rows_per_group, **limits)
    walk = _distinct_levels if distinct_edges else _path_levels
    out, cut_off = walk(stored, start.select(F.col("bri").alias("input_bri")).distinct(), max_depth)
    if max_depth is not None:
        out = out.withColumn("cut_off", F.lit(cut_off))
    return out.withColumnRenamed("relationship_level", "declared_level")


def _path_levels(stored: StoredEdges, start: DataFrame, max_depth: int | None) -> tuple[DataFrame, bool]:
    frontier, levels = start.withColumn("path", F.array("input_bri")), []
    for level in itertools.count():
        step, n = _counted(
            stored.leaving(frontier)
            .filter(~F.array_contains("path", F.col("output_bri")))
            .select(*EDGE, F.lit(level).alias("level"), F.array_append("path", F.col("output_bri")).alias("path"))
        )
        if not n or level == max_depth:
            return reduce(DataFrame.unionByName, levels or [step]), n > 0
        levels.append(step)
        frontier = step.select(F.col("output_bri").alias("input_bri"), "path")


def _distinct_levels(stored: StoredEdges, start: DataFrame, max_depth: int | None) -> tuple[DataFrame, bool]:
    """Only nodes are walked; the edges are joined to the levels of their inputs at the end."""
    frontier, n = _counted(start)
    levels, cut_off = [], False
    for level in itertools.count():
        if not n:
            break
        if level == max_depth:
            cut_off = not stored.leaving(frontier, "left_semi").isEmpty()
            break
        levels.append(frontier.withColumn("level", F.lit(level)))
        reached = stored.leaving(frontier, "left_semi").select(F.col("output_bri").alias("input_bri")).distinct()
        # Both sides hold each node once.
        seen = reduce(DataFrame.unionByName, [x.select("input_bri") for x in levels])
        frontier, n = _counted(reached.join(seen, "input_bri", "left_anti"))
    nodes = reduce(DataFrame.unionByName, levels) if levels else start.limit(0).withColumn("level", F.lit(0))
    return stored.leaving(nodes).select(*EDGE, "level"), cut_off
