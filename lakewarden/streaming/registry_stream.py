"""Keep the metadata registry up to date from a stream of change events.

The registry is a log. Below its folder, for batch N:

* ``state/batch=N/bucket=B``: the new row of every key that the batch changed, nothing else
* ``changes/batch=N/bucket=B``: its events and what became of them, and those earlier events whose fate it changed
* ``dead/batch=N``: texts that are no valid events
* ``manifest/batch=N``: one row, written last; a batch without it never happened

What holds is the row of the latest batch, per key or per event. ``compact`` writes these rows as a new base,
``base/upto=N``, from which later batches and readers go on; it may run beside the stream. A bucket holds the keys of
one hash value, so a batch reads only buckets of its own keys.

The result does not depend on how events are dealt into batches. An event that comes after later ones of its key makes
the batch fold that key again from all its stored events. A repeated event counts once; of different events with the
same key and sequence number the one that sorts first counts and the others are ``rejected_same_seq``.

A batch that is written again gives the same rows, because it reads only the batches before it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewarden.operators.registry import (
    STRING_MAP,
    distinct_events,
    fold_events,
    images,
    mark_events,
    same_content,
    split_events,
)
from lakewarden.operators.skew import lookup_join
from lakewarden.settings import ROWS_PER_GROUP

STATE = "bri STRING, alive BOOLEAN, last_seq BIGINT, fields MAP<STRING,STRING>"
CHANGES = "bri STRING, seq BIGINT, action STRING, fields MAP<STRING,STRING>, status STRING"
PLACE = "batch BIGINT, bucket INT"
NO_BASE = -1


def _base(spark: SparkSession, path: str, before: int) -> int:
    """The last base that holds only batches below ``before``."""
    bases = spark.read.schema("buckets INT, upto BIGINT").parquet(f"{path}/compacted")
    return bases.filter(F.col("upto") < before).agg(F.coalesce(F.max("upto"), F.lit(NO_BASE))).first()[0]


def _last(spark: SparkSession, path: str) -> int:
    return spark.read.schema("buckets INT, batch BIGINT").parquet(f"{path}/manifest").agg(F.max("batch")).first()[0]


def _log(spark: SparkSession, path: str, kind: str, schema: str, before: int, base: int | None = None) -> DataFrame:
    """All rows of the base and of the batches after it, up to ``before``."""
    base = _base(spark, path, before) if base is None else base
    out = spark.read.schema(f"{schema}, {PLACE}")
    later = [f"{path}/{kind}/batch={n}" for n in range(base + 1, before)]
    if base == NO_BASE and not later:
        return spark.createDataFrame([], f"{schema}, {PLACE}")
    parts = []
    if base != NO_BASE:
        parts.append(out.parquet(f"{path}/base/upto={base}/{kind}"))
    if later:
        parts.append(spark.read.schema(f"{schema}, {PLACE}").option("basePath", f"{path}/{kind}").parquet(*later))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest_state(rows: DataFrame) -> DataFrame:
    names = [c.strip().split()[0] for c in STATE.split(", ")][1:]
    last = rows.groupBy("bri").agg(F.max_by(F.struct(*names, "batch", "bucket"), "batch").alias("s"))
    return last.select("bri", "s.*")


def _newest_changes(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("bri", "seq", "action", same_content("fields").alias("_same")).agg(
        F.max_by(F.struct("fields", "status", "batch", "bucket"), "batch").alias("s")
    )
    return last.select("bri", "seq", "action", "s.*")


def _write(rows: DataFrame, path: str) -> None:
    # A file per bucket, more where a bucket is large.
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _mark(spark: SparkSession, path: str, buckets: int) -> None:
    spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")).write.mode("overwrite").parquet(path)


def _check_buckets(spark: SparkSession, path: str, batch: int, buckets: int) -> None:
    stored = spark.read.schema("buckets INT").parquet(f"{path}/manifest/batch={batch - 1}").first()[0]
    if stored != buckets:
        raise ValueError(f"the registry at {path} has {stored} buckets, not {buckets}")


def apply_batch(
    lines: DataFrame,
    batch: int,
    path: str,
    buckets: int = 64,
    rows_per_group: int = ROWS_PER_GROUP,
) -> None:
    """Fold one batch of (value, seq) texts into the registry at ``path``. Batches are numbered from 0 without gaps."""
    spark = lines.sparkSession
    if batch == 0:
        _mark(spark, f"{path}/compacted/upto={NO_BASE}", buckets)
    else:
        _check_buckets(spark, path, batch, buckets)
    base = NO_BASE if batch == 0 else _base(spark, path, batch)
    kept = []

    def held(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    try:
        events, dead = split_events(held(mark_events(lines)))
        bucket = F.pmod(F.xxhash64("bri"), F.lit(buckets)).cast("int")
        keys = held(events.groupBy("bri").agg(F.min("seq").alias("_low")))
        touched = [r[0] for r in keys.select(bucket.alias("b")).distinct().collect()]

        def stored_rows(kind: str, schema: str) -> DataFrame:
            return _log(spark, path, kind, schema, batch, base).filter(F.col("bucket").isin(touched))

        # The state has at most one row per key and batch: no key is hot.
        old = held(_newest_state(stored_rows("state", STATE).join(keys, "bri", "left_semi")).join(keys, "bri"))
        # A key with an event not after its last one is folded again from its stored events.
        late = old.filter(F.col("_low") <= F.col("last_seq"))
        images_before = old.filter(F.col("_low") > F.col("last_seq")).select(
            "bri",
            F.col("last_seq").alias("seq"),
            F.when(F.col("alive"), "create").otherwise("delete").alias("action"),
            F.coalesce("fields", F.map_from_arrays(F.array(), F.array()).cast(STRING_MAP)).alias("fields"),
            F.lit("image").alias("was"),
        )
        fresh = events.select("bri", "seq", "action", "fields", F.lit(None).cast("string").alias("was"))
        every = fresh.unionByName(images_before)
        if not late.isEmpty():
            of_late = lookup_join(
                stored_rows("changes", CHANGES), late.select("bri"), ["bri"], "left_semi", rows_per_group=rows_per_group
            )
            before = _newest_changes(of_late)
            every = every.unionByName(
                before.select("bri", "seq", "action", "fields", F.col("status").alias("was"))
            )
        single = held(distinct_events(every, "was"))
        folded = held(fold_events(single.filter("counts").drop("counts"), rows_per_group=rows_per_group))
        lost = single.filter("NOT counts").withColumn("status", F.lit("rejected_same_seq"))
        names = ["bri", "seq", "action", "fields", "status", "was"]
        changes = folded.select(*names).unionByName(lost.select(*names))
        changes = changes.filter(F.col("was").isNull() | ~F.col("was").isin("image") & (F.col("was") != F.col("status")))
        state = images(folded).select("bri", "alive", "last_seq", "fields", bucket.alias("bucket"))
        # Three jobs side by side; the batch is marked when all are done.
        with ThreadPoolExecutor(3) as pool:
            jobs = [
                pool.submit(_write, changes.drop("was").withColumn("bucket", bucket), f"{path}/changes/batch={batch}"),
                pool.submit(_write, state, f"{path}/state/batch={batch}"),
                pool.submit(dead.write.mode("overwrite").parquet, f"{path}/dead/batch={batch}"),
            ]
            for job in jobs:
                job.result()
        _mark(spark, f"{path}/manifest/batch={batch}", buckets)
    finally:
        for df in kept:
            df.unpersist()


def compact(spark: SparkSession, path: str) -> int:
    """Write the rows that hold after the last whole batch as a new base, and return the number of that batch. Older
    bases and batches are not deleted: remove them when no reader or batch that began before is running."""
    last = _last(spark, path)
    buckets = spark.read.schema("buckets INT").parquet(f"{path}/manifest/batch={last}").first()[0]
    newest = {"state": (STATE, _newest_state), "changes": (CHANGES, _newest_changes)}
    for kind, (schema, rows) in newest.items():
        _write(rows(_log(spark, path, kind, schema, last + 1)), f"{path}/base/upto={last}/{kind}")
    _mark(spark, f"{path}/compacted/upto={last}", buckets)
    return last


def stream_registry(
    source: DataFrame,
    path: str,
    buckets: int = 64,
    once: bool = False,
    rows_per_group: int = ROWS_PER_GROUP,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start the continuous run; with ``once`` it ends when the waiting events are folded.

    ``source`` is a stream of (value, seq). Offsets are checkpointed below ``path``.
    """

    def step(lines: DataFrame, batch: int) -> None:
        apply_batch(lines, batch, path, buckets, rows_per_group)

    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/offsets")
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The living keys (bri, alive, last_seq, fields) after the last whole batch."""
    rows = _log(spark, path, "state", STATE, _last(spark, path) + 1)
    return _newest_state(rows).drop("batch", "bucket").filter("alive")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All events and what became of them, with the number of the batch that decided it."""
    rows = _log(spark, path, "changes", CHANGES, _last(spark, path) + 1)
    return _newest_changes(rows).drop("bucket")
