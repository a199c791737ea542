"""The metadata registry: change events, current entities, history and child columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.skew import lookup_join, numbered, previous, split_blocks
from lakewarden.settings import ROWS_PER_GROUP

# The entity fields, their types and the defaults of absent fields.
ENTITY_FIELDS = {
    "metadatatype": ("string", "Metadata"),
    "businessDescription": ("string", None),
    "businessTitle": ("string", None),
    "metadataclass": ("string", "relational"),
    "datatype": ("string", None),
    "name": ("string", None),
    "nullable": ("boolean", "false"),
    "primaryKeyColumn": ("boolean", "false"),
    "retention": ("int", "365"),
    "tag": ("array<string>", "[]"),
    "additional_metadata": ("variant", "{}"),
}
REQUIRED = ("datatype", "bri", "name")
NOT_NULL = ("metadatatype", "metadataclass")
ACTIONS = ("create", "update", "delete")

STRING_MAP = "map<string,string>"


def _typed(text: Column, dtype: str) -> Column:
    if dtype == "string":
        return text
    if dtype == "array<string>":
        return F.from_json(text, dtype)
    if dtype == "variant":
        return F.try_parse_json(text)
    return text.try_cast(dtype)


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows carry ``reason``, the missing required fields."""
    missing = F.array_compact(
        F.array(
            *[F.when(F.col(c).isNull() | (F.trim(c) == ""), F.lit(c)) for c in REQUIRED]
        )
    )
    checked = df.withColumn("reason", F.array_join(missing, ", "))
    return (
        checked.filter("reason = ''").drop("reason"),
        checked.filter("reason <> ''").withColumn("reason", F.concat(F.lit("missing: "), "reason")),
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    """Put the default in place of each missing value (and add absent columns)."""
    for name, (dtype, default) in ENTITY_FIELDS.items():
        standard = _typed(F.lit(default).cast("string"), dtype)
        value = F.lit(None).cast(dtype)
        if name in df.columns:
            is_text = isinstance(df.schema[name].dataType, T.StringType)
            value = _typed(F.col(name), dtype) if is_text else F.col(name)
        df = df.withColumn(name, F.coalesce(value, standard))
    return df


def mark_events(df: DataFrame, value: str = "value", seq: str = "seq") -> DataFrame:
    """(value, seq, bri, action, fields, reason) of JSON texts; see ``parse_events``."""
    # Read as a list of events, text behind the first one shows.
    listed = F.concat(F.lit("["), value, F.lit("]"))
    events = F.from_json(listed, f"array<struct<action:string,bri:string,metadata:{STRING_MAP}>>")
    event = F.when(F.size(events) == 1, F.get(events, F.lit(0)))
    parsed = df.select(F.col(value).alias("value"), F.col(seq).alias("seq"), event.alias("e"))
    action, fields = F.col("e.action"), F.col("e.metadata")
    bri = F.when(action == "delete", F.col("e.bri")).otherwise(F.element_at(fields, F.lit("bri")))
    absent = F.array_compact(
        F.array(*[F.when(F.element_at(fields, F.lit(c)).isNull(), F.lit(c)) for c in REQUIRED])
    )
    reason = (
        F.when(action.isNull(), "not an event")
        .when(~action.isin(*ACTIONS), "unknown action")
        .when(F.col("seq").isNull(), "no sequence number")
        .when(bri.isNull(), "no bri")
        .when(
            (action == "create") & (F.size(absent) > 0),
            F.concat(F.lit("missing: "), F.array_join(absent, ", ")),
        )
    )
    return parsed.select(
        "value",
        "seq",
        bri.alias("bri"),
        action.alias("action"),
        F.coalesce(fields, F.map_from_arrays(F.array(), F.array()).cast(STRING_MAP)).alias("fields"),
        reason.alias("reason"),
    )


def parse_events(
    df: DataFrame, value: str = "value", seq: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of JSON texts ``{action, metadata}`` or ``{action, bri}``.

    events: bri, seq, action, fields (the keys present in ``metadata``, as a map of
    strings, whose values may be NULL). Dead letters: value, seq and the reason.
    """
    return split_events(mark_events(df, value, seq))


def split_events(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    events = marked.filter("reason IS NULL").select("bri", "seq", "action", "fields")
    return events, marked.filter("reason IS NOT NULL").select("value", "seq", "reason")


def same_content(fields: str) -> Column:
    """A text that is equal for maps with the same entries."""
    return F.to_json(F.array_sort(F.map_entries(fields)), {"ignoreNullFields": "false"})


def distinct_events(events: DataFrame, *marks: str, key: str = "bri", seq: str = "seq") -> DataFrame:
    """One row per different event (key, seq, action, fields), with the largest of each of the text columns ``marks``,
    and ``counts``: whether it sorts first among the events of its key and number. A key should have one event per
    number; if it has several, which one counts does not depend on their order of arrival."""
    single = events.groupBy(key, seq, "action", same_content("fields").alias("_same")).agg(
        F.any_value("fields").alias("fields"), *[F.max(m).alias(m) for m in marks]
    )
    # Groups of different events with one number are small.
    first = F.row_number().over(Window.partitionBy(key, seq).orderBy("action", "_same"))
    return single.withColumn("counts", first == 1).drop("_same")


def fold_events(
    events: DataFrame,
    key: str = "bri",
    seq: str = "seq",
    rows_per_group: int = ROWS_PER_GROUP,
    keep_blocks: bool = False,
) -> DataFrame:
    """Add ``status`` and ``life`` to ordered create / update / delete events.

    status: applied; rejected_duplicate (create of a living key); ignored_missing (update or
    delete of a key that does not live); ignored_action (any other action). ``life`` is the
    seq of the create that began the key's present life, for applied events.

    A key lives if its last create or delete is a create, whatever became of that event. So
    one look back per row decides, and keys with very many events are split.
    """
    df = split_blocks(events, [key], [seq], rows_per_group)
    action = F.col("action")
    marker = F.when(action.isin("create", "delete"), action)
    df = previous(df, [key], [seq], {"_before": marker}, None, keep_blocks=True)
    lives = F.coalesce(F.col("_before") == "create", F.lit(False))
    status = (
        F.when(action == "create", F.when(lives, "rejected_duplicate").otherwise("applied"))
        .when(action.isin("update", "delete"), F.when(lives, "applied").otherwise("ignored_missing"))
        .otherwise("ignored_action")
    )
    df = df.withColumn("status", status).drop("_before")
    birth = F.when((F.col("status") == "applied") & (action == "create"), F.col(seq))
    df = previous(df, [key], [seq], {"_birth": birth}, None, keep_blocks=keep_blocks)
    life = F.when(F.col("status") == "applied", F.coalesce(birth, F.col("_birth")))
    return df.withColumn("life", life).drop("_birth")


def images(
    folded: DataFrame, fields: Sequence[str] | None = None, key: str = "bri", seq: str = "seq"
) -> DataFrame:
    """(key, alive, life, last_seq, n_changes, fields): the last image of every key.

    ``fields`` holds the fields present in the key's last life, each with its last value: all of
    them, or only those that the caller names. Aggregates combine on each task before the shuffle.
    """
    applied = F.col("status") == "applied"
    whole = folded.groupBy(key).agg(
        F.max("life").alias("life"),
        F.max(F.when(applied & (F.col("action") == "delete"), F.col(seq))).alias("_gone"),
        F.max(seq).alias("last_seq"),
        F.count_if(applied).alias("n_changes"),
    )
    changes = folded.filter(applied & F.col("action").isin("create", "update"))
    entries = changes.select(key, seq, "life", F.explode("fields").alias("_field", "_value"))
    if fields is not None:
        entries = entries.filter(F.col("_field").isin(list(fields)))
    last = entries.groupBy(key, "_field").agg(
        F.max_by(F.struct("life", F.struct(F.col("_field").alias("key"), F.col("_value").alias("value")).alias("e")),
                 seq).alias("_last"))
    # As many entries as the entity has fields.
    held = last.groupBy(key).agg(F.collect_list("_last").alias("_last"))
    joined = whole.join(held, key, "left")
    own = F.filter("_last", lambda x: x["life"] == F.col("life"))
    none = F.map_from_arrays(F.array(), F.array()).cast(STRING_MAP)
    alive = F.col("life").isNotNull() & (F.col("_gone").isNull() | (F.col("_gone") < F.col("life")))
    return joined.select(
        key,
        alive.alias("alive"),
        "life",
        "last_seq",
        "n_changes",
        F.coalesce(F.map_from_entries(F.array_sort(F.transform(own, lambda x: x["e"]))), none).alias("fields"),
    )


def current(
    events: DataFrame, fields: Sequence[str] | None = None, key: str = "bri", seq: str = "seq",
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """The living keys and their images."""
    folded = fold_events(events, key, seq, rows_per_group)
    return images(folded, fields, key, seq).filter("alive")


def entities(living: DataFrame) -> DataFrame:
    """Typed entity columns from images; absent fields get their defaults."""
    columns = [F.col("bri")]
    for name, (dtype, default) in ENTITY_FIELDS.items():
        value = F.element_at("fields", F.lit(name))
        present = F.map_contains_key("fields", name)
        standard = F.lit(default).cast("string")
        text = F.when(present, value).otherwise(standard)
        if name in NOT_NULL:
            text = F.coalesce(text, standard)
        columns.append(_typed(text, dtype).alias(name))
    return living.select(*columns)


def history(
    events: DataFrame, key: str = "bri", seq: str = "seq", rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """The applied changes of every key, numbered from 1 in ``version``."""
    folded = fold_events(events, key, seq, rows_per_group, keep_blocks=True)
    return numbered(folded.filter("status = 'applied'"), [key], [seq], "version", None)


def find_entity(df: DataFrame, bri: str) -> DataFrame:
    return df.filter(F.col("bri") == bri)


def with_columns(
    metadata: DataFrame,
    columns: DataFrame,
    part_size: int = 10_000,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Metadata with ``columns``, the nested list of their columns in order of ``id``; its key is (bri, part).

    ``part`` is 0 for an entity of up to ``part_size`` columns; a larger one has several rows, parts 0, 1 and so on,
    so that no row grows without bound. An entity without columns has part 0 with an empty list.
    """
    ranked = numbered(columns, ["bri"], ["id"], "_rn", rows_per_group)
    part = ((F.col("_rn") - 1) / part_size).cast("int")
    child = F.struct(F.col("_rn").alias("rn"), *[c for c in columns.columns if c != "bri"])
    parts = (
        ranked.withColumn("part", part)
        .groupBy("bri", "part")
        .agg(F.sort_array(F.collect_list(child)).alias("_children"))
    )
    children = F.transform("_children", lambda c: c.dropFields("rn"))
    nested = parts.withColumn("columns", children).drop("_children")
    dtype = nested.schema["columns"].dataType
    return metadata.join(nested, "bri", "left").select(
        *metadata.columns,
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("columns", F.array().cast(dtype)).alias("columns"),
    )


def upsert_columns(
    columns: DataFrame, updates: DataFrame, metadata: DataFrame | None = None, **limits
) -> DataFrame:
    """Columns (id, bri, ...) after updates (id, seq, bri, fields map).

    A known id is overlaid with the fields present in its updates, in order of seq; an unknown
    id is inserted. Updates of an entity that is not in ``metadata`` are ignored.
    """
    if metadata is not None:
        updates = lookup_join(updates, metadata.select("bri").distinct(), ["bri"], "left_semi", **limits)
    names = [c for c in columns.columns if c not in ("id", "bri")]

    def last_present(f: str) -> Column:
        at = F.when(F.map_contains_key("fields", f), F.col("seq"))
        return F.max_by(F.struct(F.element_at("fields", F.lit(f)).alias("value")), at)

    folded = updates.groupBy("id").agg(
        F.min_by("bri", "seq").alias("_bri"),
        *[last_present(f).alias(f"_u_{f}") for f in names],
    )
    joined = columns.join(folded, "id", "full_outer")
    values = {
        f: F.when(
            F.col(f"_u_{f}").isNotNull(), F.col(f"_u_{f}.value").cast(columns.schema[f].dataType)
        ).otherwise(F.col(f))
        for f in names
    }
    values["bri"] = F.coalesce("bri", "_bri")
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in columns.columns])


def delete_cascade(
    metadata: DataFrame, columns: DataFrame, gone: DataFrame,
    rows_per_group: int = ROWS_PER_GROUP, **limits,
) -> tuple[DataFrame, DataFrame]:
    """(metadata, columns) without the entities in ``gone`` (bri) and without their columns."""
    lookup = gone.select("bri").dropna().distinct()
    rest = [
        lookup_join(df, lookup, ["bri"], "left_anti", rows_per_group=rows_per_group, **limits)
        for df in (metadata, columns)
    ]
    return rest[0], rest[1]
