import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.reduce import keyed_reduce, rolling_reduce, window_reduce
from tidepool.sources.records import from_tuples


def test_tree_reduce_matches_builtin_with_a_hot_key(spark):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(7)}", rnd.randrange(-100, 100))
            for _ in range(5000)] + [("nulls", None)]
    df = from_tuples(spark, rows, "key string, v long")
    got = {r.key: r.value for r in keyed_reduce(df, ["key"], F.col("v"), lambda a, b: a + b, fanin=8).collect()}
    exp = {}
    for k, v in rows:
        if v is not None:
            exp[k] = exp.get(k, 0) + v
    assert got == {**exp, "nulls": None} or got == exp
    mx = {r.key: r.value for r in keyed_reduce(df, ["key"], F.col("v"), lambda a, b: F.greatest(a, b), fanin=3).collect()}
    assert mx["hot"] == max(v for k, v in rows if k == "hot")


def test_identical_rows_of_a_key_count_once_each(spark):
    df = spark.range(20_000).select(F.lit("k").alias("key"), F.lit(1).cast("long").alias("v")).union(
        spark.range(1000).select(F.lit("m").alias("key"), (F.col("id") % 3).alias("v")))
    got = {r.key: r.value for r in keyed_reduce(df, ["key"], F.col("v"), lambda a, b: a + b, fanin=2).collect()}
    assert got == {"k": 20_000, "m": 999}
    one = keyed_reduce(df, ["key"], F.lit((1 << 62) - 1).cast("long"), lambda a, b: F.greatest(a, b))
    assert {r.value for r in one.collect()} == {(1 << 62) - 1}


@pytest.mark.parametrize("n_blocks", [1, 4, 9])
def test_rolling_reduce_keeps_the_order_of_a_combine_that_does_not_commute(spark, n_blocks):
    rows = [("a" if i % 3 else None, i, None if i % 5 == 0 else chr(97 + i % 26)) for i in range(60)]
    df = from_tuples(spark, rows, "key string, o long, v string")
    got = rolling_reduce(df, ["key"], ["o"], F.col("v"), lambda a, b: F.concat(a, b), "s", n_blocks=n_blocks)
    text, exp = {}, {}
    for k, o, v in rows:
        if v is not None:
            text[k] = text.get(k, "") + v
        exp[k, o] = text.get(k)
    assert {(r.key, r.o): r.s for r in got.collect()} == exp
    assert rolling_reduce(df.where("false"), ["key"], ["o"], F.col("v"), lambda a, b: F.concat(a, b)).count() == 0


def test_window_reduce_with_a_hot_window(spark):
    rows = [("k", i % 40, i) for i in range(1000)] + [("k", None, 5), ("m", 7, None), ("m", -3, 2)]
    df = from_tuples(spark, rows, "key string, t long, v long").withColumn("ts", F.timestamp_micros("t"))
    got = {(r.key, r.s): r.v for r in window_reduce(
        df, ["key"], "ts", 15, 6, F.col("v"), lambda a, b: F.greatest(a, b), "v", fanin=4)
        .select("key", F.unix_micros("window_start").alias("s"), "v").collect()}
    exp = {}
    for k, t, v in rows:
        if t is not None and v is not None:
            for s in range(-30, 60, 6):
                if s <= t < s + 15:
                    exp[k, s] = max(v, exp.get((k, s), v))
    assert got == exp
