"""What several operators of this package share.

Words are runs of bytes other than space and 0x09-0x0D, and only A-Z are lower-cased, so texts are
handled as UTF-8 bytes: ``bytes.split`` and ``bytes.lower`` do exactly that. A NULL text is an empty
text. A NULL id is the empty string where an id is hashed.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewarden.settings import fresh_path, work_dir

# Rows that one bucket of a numbered group holds, about.
ROWS_PER_BUCKET = 200_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def clean_worker() -> Callable[[], None]:
    """For the first call in a task: frees what earlier tasks of the same Python worker left in reference cycles
    (functions sent by value hold their tables and caches)."""
    done: list[bool] = []

    def clean() -> None:
        if not done:
            gc.collect()
            done.append(True)

    return clean


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that long texts are not all unpacked at once."""
    gc.collect()  # see clean_worker
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A long text in pieces of about ``size`` bytes that end at a space or line end: words stay whole."""
    at = 0
    while len(text) - at > size:
        end = max(text.rfind(b" ", at, at + size), text.rfind(b"\n", at, at + size))
        if end < at:
            ends = [x for x in (text.find(b" ", at + size), text.find(b"\n", at + size)) if x >= 0]
            if not ends:
                break
            end = min(ends)
        yield text[at : end + 1]
        at = end + 1
    yield text[at:] if at else text


def id_crc(column: Column) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def table_of(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later uses do not compute it again, and a
    lost executor costs nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    work_dir(df.sparkSession)
    return df.checkpoint()


def position(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone, evenly spread."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)).cast("double") / float(1 << 53)


def sampled(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` rows of a frame of small rows, at most: those whose columns hash below a cut that follows
    from the count. All rows, if there are no more. No task sees more than its own rows."""
    n = df.count()
    return df if n <= rows else df.filter(position(*[F.col(c) for c in columns]) < 0.95 * rows / n)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows whose count ``n`` is above a cut: the lowest one that leaves at most ``most`` rows. The cut is
    found from the numbers of rows per (rounded) count, so rows are not sorted or moved."""
    small = 1024
    fine = F.floor(F.log2(F.col(n) / small) * small) + small
    level = F.when(F.col(n) < small, F.col(n)).otherwise(fine)
    sizes = {r["_l"]: r["_n"] for r in counts.groupBy(level.alias("_l")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    cut, total = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        cut = at
    return counts.filter(level >= cut)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    order: Sequence[str],
    name: str,
    rows: int = ROWS_PER_BUCKET,
    weight: str | None = None,
) -> DataFrame:
    """Add the 0-based number of each row inside its group, in the order of ``at``, then ``order``. With
    ``weight`` a row stands for as many rows, and its number is that of the first.

    ``at`` names a column with values spread evenly over [0, 1). A group of many rows is cut by it into
    buckets of about ``rows`` rows that are numbered apart; the counts of the earlier buckets are added.
    So no task holds a whole group.
    """
    buckets = (
        df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows)
        .withColumn("_buckets", F.ceil(F.col("_n") / rows))
        .drop("_n")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    # There are at most (rows of df / rows) large groups.
    cut = (
        df.join(F.broadcast(buckets), same, "left")
        .withColumn("_bucket", F.floor(F.col(at) * F.coalesce("_buckets", F.lit(1))))
        .drop("_buckets", *[f"_g_{k}" for k in keys])
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(at, *order)
    if weight is None:
        out = cut.withColumn(name, F.row_number().over(inside) - 1)
    else:
        above = inside.rowsBetween(Window.unboundedPreceding, -1)
        out = cut.withColumn(name, F.coalesce(F.sum(weight).over(above), F.lit(0)))
    own = F.count(F.lit(1)) if weight is None else F.sum(weight)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Groups of one bucket need no offset; the others have at most (rows of df / rows * 2) buckets.
    offsets = (
        cut.join(F.broadcast(buckets), same, "left_semi")
        .groupBy(*keys, "_bucket")
        .agg(own.alias("_n"))
        .select(
            *[F.col(k).alias(f"_g_{k}") for k in keys],
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        )
    )
    return (
        out.join(F.broadcast(offsets), [*same, F.col("_bucket") == F.col("_b")], "left")
        .withColumn(name, (F.col(name) + F.coalesce("_offset", F.lit(0))).cast("long"))
        .drop("_bucket", "_b", "_offset", *[f"_g_{k}" for k in keys])
    )
