"""Example rows for tests."""

from pyspark.sql import functions as F


def transactions(spark, n, seed=0):
    """Shop receipts: a number, a till, a total, the way of payment, a day and whether it was returned."""
    at = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000))
    return spark.range(n).select(
        "id",
        (at % 40).cast("int").alias("till"),
        (at / 100.0).alias("total"),
        F.element_at(F.array(F.lit("card"), F.lit("cash"), F.lit("voucher")), (at % 3 + 1).cast("int")).alias("paid_by"),
        F.date_add(F.lit("2023-06-01").cast("date"), (at % 200).cast("int")).alias("day"),
        (at % 11 == 0).alias("returned"),
    )
