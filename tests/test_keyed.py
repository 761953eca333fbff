import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from leakscope.operators import keyed, quality, ranking


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_insert_ignore_and_update(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(keyed.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(keyed.insert_ignore(old, new.union(new), ["k"])) == [(3, "C")]
    to_null = spark.createDataFrame([(1, None)], "k int, v string")
    assert sorted(rows(keyed.join_update(old, to_null, ["k"], ["v"])), key=str) == [(1, None), (2, "b")]


def test_delete_keeps_unknown_condition(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "k int, v int")
    assert [r.k for r in keyed.delete_where(df, F.col("v") > 3).orderBy("k").collect()] == [2, 3]


def test_clear_flags_and_keep_first(spark):
    df = spark.createDataFrame([(1, True), (2, True)], "k int, flag boolean")
    done = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(keyed.set_where_key_in(df, done, "k", "flag", F.lit(False))) == [(1, True), (2, False)]
    dup = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 3)], "k int, v string, o int")
    assert rows(keyed.keep_first(dup, ["k"], "o")) == [(1, "y", 1), (2, "z", 3)]


def test_percent_rank_equals_window(spark):
    rnd = random.Random(1)
    data = [(i, rnd.choice([0.1, 0.1, 0.5, 0.999999, 1.0, round(rnd.random(), 6)])) for i in range(400)]
    df = spark.createDataFrame(data, "i int, x double").select("i", F.col("x").cast("decimal(8,6)").alias("x"))
    got = ranking.percent_rank_by_value(df, "x", "r")
    want = df.withColumn("r", F.percent_rank().over(Window.orderBy("x")))
    assert {t.i: t.r for t in got.collect()} == {t.i: t.r for t in want.collect()}


def test_percent_rank_of_one_row(spark):
    df = spark.range(1).select(F.lit("0.5").cast("decimal(8,6)").alias("x"))
    assert ranking.percent_rank_by_value(df, "x", "r").first().r == 0.0


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "string", "timestamp", "bigint"])
def test_percent_rank_of_any_type(spark, kind):
    rnd = random.Random(kind)
    values = [None, None, -5.0, 0.0, 0.0, 1e6, 2000.0] + [float(rnd.randint(-300, 300)) for _ in range(300)] + [7.0] * 150
    df = spark.createDataFrame(list(enumerate(values)), "i int, d double")
    x = F.timestamp_seconds("d") if kind == "timestamp" else F.col("d").cast(kind)
    df = df.select("i", x.alias("x")).repartition(5)
    if kind == "double":
        df = df.unionByName(spark.createDataFrame([(9000, float("nan")), (9001, float("inf")), (9002, -0.0)], df.schema))
    want = {t.i: t.r for t in df.withColumn("r", F.percent_rank().over(Window.orderBy("x"))).collect()}
    for ranges in (1, 4, 50):
        assert {t.i: t.r for t in ranking.percent_rank_by_value(df, "x", "r", ranges).collect()} == want
    assert ranking.percent_rank_by_value(df.filter("false"), "x", "r").count() == 0


def test_numbering_spreads_a_hot_key(spark):
    # one key holds two thirds of all rows
    data = [("hot", i // 2) for i in range(2000)] + [(f"k{i % 300}", i) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, o int").repartition(7)
    got = ranking.number_rows(df, ["k"], ["o"], "n", partitions=6)
    per_key = {}
    for r in got.collect():
        per_key.setdefault(r.k, []).append((r.o, r.n))
    assert sum(map(len, per_key.values())) == len(data)
    for pairs in per_key.values():
        pairs.sort(key=lambda p: p[1])
        assert [n for _, n in pairs] == list(range(1, len(pairs) + 1))
        assert [o for o, _ in pairs] == sorted(o for o, _ in pairs)


def test_last_n_and_top_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "k string, t int")
    assert rows(ranking.last_n(df, "k", "t", 2)) == [("a", 8), ("a", 9), ("b", 1)]
    assert rows(ranking.top_per_group(df, "k", [F.col("t")], 1, out="r")) == [("a", 0, 1), ("b", 1, 1)]


def test_quality_checks(spark):
    orders = spark.createDataFrame([(1, "delivered"), (1, "lost"), (2, None)], "order_id int, order_status string")
    items = spark.createDataFrame([(1,), (9,), (9,), (None,)], "order_id int")
    assert quality.duplicate_count(orders, ["order_id"], "o").first().violations == 1
    assert quality.orphan_count(items, "order_id", orders.select("order_id").distinct(), "order_id", "i").first().violations == 2
    assert quality.domain_violations(orders, "order_status", "order_status").first().violations == 1

