import random

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import skew


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for seq in range(3000):
        key = rnd.choice(["hot", "hot", "hot", None, None, "a", "b", "c", f"k{seq % 50}"])
        value = rnd.choice([None, seq % 11])
        data.append((key, seq, value))
    rnd.shuffle(data)
    return data


@pytest.mark.parametrize("limit", [50, 100, 700, 10_000])
@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_previous_and_numbered_equal_a_loop(spark, rows, limit, kind):
    df = spark.createDataFrame(rows, "key STRING, seq INT, value INT")
    order = {
        "int": F.col("seq"),
        "string": F.format_string("s%05d", "seq"),
        "date": F.date_add(F.lit("2000-01-01").cast("date"), F.col("seq")),
    }[kind]
    df = df.withColumn("at", order)
    prev = skew.previous(df, ["key"], ["at"], {"prev": F.col("value")}, limit)
    both = skew.numbered(prev, ["key"], ["at"], "rn", limit)
    assert sorted(both.columns) == ["at", "key", "prev", "rn", "seq", "value"]
    got = {(r.key, r.seq): (r.prev, r.rn) for r in both.collect()}
    last, count, want = {}, {}, {}
    for key, seq, value in sorted(rows, key=lambda r: r[1]):
        count[key] = count.get(key, 0) + 1
        want[key, seq] = (last.get(key), count[key])
        if value is not None:
            last[key] = value
    assert got == want


def test_no_key_orders_the_whole_table(spark, rows):
    df = spark.createDataFrame(rows, "key STRING, seq INT, value INT")
    out = skew.previous(df, [], ["seq"], {"prev": F.col("seq")}, 100)
    assert "_all" not in out.columns
    assert {r.seq: r.prev for r in out.collect()} == {
        s: (s - 1 if s else None) for s in range(3000)
    }


def sizes(df, order, limit):
    blocks = skew.split_blocks(df, ["key"], order, limit)
    return [r["count"] for r in blocks.groupBy("key", skew.BLOCK).count().filter("key = 'hot'").collect()]


ORDERS = {
    "plain": ["seq"],
    "long prefix": ["name"],
    "two values first": ["two", "seq"],
    "ties": ["two"],
}


@pytest.mark.parametrize("order", ORDERS.values(), ids=ORDERS.keys())
def test_blocks_are_bounded_and_in_order(spark, order):
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
        F.col("id").alias("seq"),
        F.format_string("a common prefix of 30 bytes: %09d", F.col("id")).alias("name"),
        F.when(F.col("id") % 6 == 0, "a").otherwise("b").alias("two"),
    )
    found = sizes(df, order, 100)
    assert sum(found) == 1000 and max(found) <= 130
    blocks = skew.split_blocks(df, ["key"], order, 100).filter(F.col(skew.BLOCK) != skew.UNSPLIT)
    ends = blocks.groupBy(skew.BLOCK).agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"))
    ends = sorted(ends.collect())
    assert all(a.high <= b.low for a, b in zip(ends, ends[1:]))
    assert skew.split_blocks(df, ["key"], order, 10_000) is df


def test_ordered_work_on_texts_and_ties(spark):
    """Values carried over blocks that share a long prefix, and numbers that are gapless in spite of ties."""
    df = spark.range(1000).select(F.lit("hot").alias("key"), F.format_string("%030d", "id").alias("at"), "id",
                                  (F.col("id") % 3).alias("few"))
    got = skew.previous(df, ["key"], ["at"], {"prev": F.when(F.col("id") % 7 == 0, F.col("id"))}, 60).collect()
    assert {r.id: r.prev for r in got} == {i: (i - 1) // 7 * 7 if i else None for i in range(1000)}
    tied = skew.numbered(df, ["key"], ["few"], "rn", 60).collect()
    assert sorted(r.rn for r in tied) == list(range(1, 1001))
    assert [r.few for r in sorted(tied, key=lambda r: r.rn)] == sorted(i % 3 for i in range(1000))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [100, 5000])
def test_lookup_join_split_equals_plain_join(spark, rows, how, hot):
    df = spark.createDataFrame(rows, "key STRING, seq INT, value INT")
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("k3", 3), ("zz", 4)], "key STRING, n INT")
    want = sorted(map(str, df.join(lookup, ["key"], how).collect()))
    small = skew.lookup_join(df, lookup, ["key"], how)
    split = skew.lookup_join(df, lookup, ["key"], how, rows_per_group=hot, max_broadcast_rows=2)
    assert sorted(map(str, small.collect())) == want
    assert sorted(map(str, split.select(*small.columns).collect())) == want


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_with_many_rows_per_hot_key(spark, rows, how):
    """A hot part beyond the broadcast bound is salted: same rows, and no broadcast of the lookup in the plan."""
    df = spark.createDataFrame(rows, "key STRING, seq INT, value INT")
    many = [("hot", i) for i in range(40)] + [("a", 2), ("a", 3), ("zz", 4)]
    lookup = spark.createDataFrame(many, "key STRING, n INT")
    want = sorted(map(str, df.join(lookup, ["key"], how).collect()))
    got = skew.lookup_join(df, lookup, ["key"], how, rows_per_group=100, max_broadcast_rows=10)
    assert sorted(map(str, got.select(*df.join(lookup, ["key"], how).columns).collect())) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        split = skew.lookup_join(df, lookup, ["key"], how, rows_per_group=100, max_broadcast_rows=10)
        plan = split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_share" in plan and "SortMergeJoin [key" in plan
    dealt = df.filter("key = 'hot'").withColumn("_share", F.expr("pmod(monotonically_increasing_id(), 9)"))
    assert dealt.groupBy("_share").count().agg(F.max("count")).first()[0] <= 200
