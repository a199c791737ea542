"""Workflow activities: standardise names, discover JSON fields, one row per workflow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.skew import lookup_join
from lakewarden.settings import ROWS_PER_GROUP, work_dir

# Names of activities and fields are a schema; more of them than this are data.
MAX_FIELDS = 100_000


def string_schema(fields: Sequence[str]) -> T.StructType:
    """A struct of nullable strings."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def standardize(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    rows_per_group: int = ROWS_PER_GROUP,
    **limits,
) -> DataFrame:
    """Replace the values of ``column`` by their standardised form, ignoring case.

    ``mapping`` has input_value and standardized_value; of several entries for one input
    the smallest value counts, so that no row is repeated.
    """
    lookup = (
        mapping.select(F.lower("input_value").alias("_input"), "standardized_value")
        .dropna()
        .groupBy("_input")
        .agg(F.min("standardized_value").alias("_standard"))
    )
    keyed = df.withColumn("_input", F.lower(column))
    joined = lookup_join(keyed, lookup, ["_input"], "left", rows_per_group=rows_per_group, **limits)
    names = [F.coalesce("_standard", column).alias(c) if c == column else c for c in df.columns]
    return joined.select(*names)


def discover_fields(df: DataFrame, key: str = "activity", json_column: str = "activity_out") -> DataFrame:
    """(activity, field): the top-level keys of all JSON objects of each activity.

    One job; equal pairs are combined on each task before the shuffle. An activity without
    any JSON object has no rows.
    """
    keys = F.explode(F.json_object_keys(json_column)).alias("field")
    return df.select(F.col(key).alias("activity"), keys).dropna().distinct()


def activity_fields(
    df: DataFrame, key: str = "activity", json_column: str = "activity_out", max_fields: int = MAX_FIELDS
) -> dict:
    """{activity: [fields]} for all activities: a configuration, as large as the schema. More than ``max_fields``
    entries are an error: then the keys are data."""
    work_dir(df.sparkSession)
    # One pass: an activity without fields has the NULL entry only.
    keys = F.explode_outer(F.json_object_keys(json_column)).alias("field")
    found = df.select(F.col(key).alias("activity"), keys).dropna(subset=["activity"]).distinct().checkpoint()
    n = found.count()
    if n > max_fields:
        raise ValueError(f"{n} pairs of activity and field, more than {max_fields}")
    rows = found.orderBy("activity", "field").collect()
    config: dict[str, list[str]] = {}
    for r in rows:
        fields = config.setdefault(r["activity"], [])
        if r["field"] is not None:
            fields.append(r["field"])
    return config


def flatten(
    df: DataFrame,
    fields: Mapping[str, Sequence[str]],
    workflow: str = "workflow_id",
    tiebreak: Sequence[str] = (),
    every_field: bool = True,
) -> DataFrame:
    """One row per workflow, with the earliest completed record of each activity.

    Columns: {activity}_status, {activity}_completion_time, {activity}_parent and
    {activity}_{field}, for every field of any activity (or, with ``every_field`` off, only
    for the activity's own). The one record chosen supplies all of them.

    One scan and one shuffle on the workflow; each task first reduces its own rows, and the
    JSON of a chosen record is parsed once, whatever the number of its fields.
    """
    record = F.struct("activity_status", "activity_completion_time", "activity_parent", "activity_out")
    time = F.col("activity_completion_time")
    at = F.struct(time.isNull().alias("late"), time.alias("time"), *tiebreak)
    chosen = df.groupBy(workflow).agg(
        *[
            F.min_by(record, F.when(F.col("activity") == activity, at)).alias(f"_{i}")
            for i, activity in enumerate(fields)
        ]
    )
    union = sorted({f for names in fields.values() for f in names})
    # Each chosen record is parsed into a column of its own, from which the fields are taken.
    out = [
        F.from_json(F.col(f"_{i}.activity_out"), string_schema(own)).alias(f"_v{i}")
        for i, own in enumerate(fields.values()) if own
    ]
    parsed = chosen.select("*", *out)
    columns = [F.col(workflow)]
    for i, (activity, own) in enumerate(fields.items()):
        row = F.col(f"_{i}")
        columns += [
            row["activity_status"].alias(f"{activity}_status"),
            row["activity_completion_time"].alias(f"{activity}_completion_time"),
            row["activity_parent"].alias(f"{activity}_parent"),
        ]
        for field in union:
            if field in own:
                columns.append(F.col(f"_v{i}").getField(field).alias(f"{activity}_{field}"))
            elif every_field:
                columns.append(F.lit(None).cast("string").alias(f"{activity}_{field}"))
    return parsed.select(*columns)
