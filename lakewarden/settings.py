"""Session settings shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A group above this many rows is "hot": it is split over several tasks.
ROWS_PER_GROUP = 2_000_000

# A lookup is broadcast only if it was counted and lies within both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Estimated input bytes per task of costly per-row work (see ``spread``).
BYTES_PER_TASK = 4 * 1024 * 1024


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (a local session) is a temporary folder made and set for this session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakewarden-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver rows as a DataFrame, by Arrow rather than through Python workers."""
    dicts = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(dicts, schema=to_arrow_schema(schema)))


def spread(df: DataFrame) -> DataFrame:
    """Give costly work to tasks of bounded size, and a small input to all cores.

    The input is repartitioned into one part per ``BYTES_PER_TASK`` of its estimated size, at
    least one per core. The estimate (the planner's, no job runs) counts compressed file bytes, and
    a file split follows row groups, so a scan's own splits of well-packed rows can hold far more
    work than their bytes say, or all of it in one: tasks are kept to a fixed share, and their
    number grows with the input. An input of unknown size is returned as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= spark._jsparkSession.sessionState().conf().defaultSizeInBytes():
        return df
    parts = max(cores, -(-size // BYTES_PER_TASK))
    return df.repartition(parts)
