"""A key holding most of the rows must be spread over many tasks."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators.delta import delta_trigger_fires
from tidepool.operators.prefix import blocked_running_totals, range_block
from tidepool.sources.records import from_tuples


def blocks_and_tasks(spark, df, n_blocks):
    out = blocked_running_totals(df, ["key"], [F.col("o")], range_block(df, F.col("o"), n_blocks, 1), {"rn": F.col("v")})
    # AQE would merge these tiny partitions into one, or broadcast the few rows
    # to the offsets; look at the plan of a large table instead.  The running
    # total is kept, so its window runs.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = out.where(F.col("key") == "hot").groupBy("_blk", F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.max("rn").alias("rn")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r.rn for r in hot) == sum(r.n for r in hot)
    return {r["_blk"]: r.n for r in hot}, {r.p for r in hot}


def test_one_hot_key_is_processed_by_many_tasks(spark):
    rows = [("hot", i, 1) for i in range(4000)] + [("cold", i, 1) for i in range(40)]
    blocks, tasks = blocks_and_tasks(spark, from_tuples(spark, rows, "key string, o long, v long"), 32)
    assert len(blocks) == 32 and len(tasks) >= 4      # 32 blocks hash over 8 shuffle partitions


def test_outliers_do_not_empty_the_blocks(spark):
    rows = [("hot", i, 1) for i in range(4000)] + [("hot", 10**15, 1), ("hot", -10**15, 1), ("hot", None, 1)]
    blocks, _ = blocks_and_tasks(spark, from_tuples(spark, rows, "key string, o long, v long"), 32)
    assert len(blocks) == 32 and max(blocks.values()) <= 2 * 4003 // 32


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-2**62, 2**62)), min_size=1, max_size=60),
       n_blocks=st.integers(1, 40))
def test_blocks_are_monotone(spark, values, n_blocks):
    df = from_tuples(spark, [(v,) for v in values], "o long")
    got = df.select("o", range_block(df, F.col("o"), n_blocks, 1).alias("b")).collect()
    got.sort(key=lambda r: (r.o is not None, r.o or 0))
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(0 <= r.b < n_blocks for r in got)
    by_value = {}
    assert all(by_value.setdefault(r.o, r.b) == r.b for r in got)


def sequential(ds, thr):
    fires, ref = [], None
    for i, d in enumerate(ds):
        if ref is None:
            ref = d
        elif d - ref > thr:
            fires.append(i)
            ref = d
    return fires


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st.lists(st.integers(0, 30), min_size=1, max_size=300), thr=st.integers(0, 60),
       n_blocks=st.integers(1, 12))
def test_delta_fold_equals_sequential_fold(spark, steps, thr, n_blocks):
    ds, d = [], 0
    for s in steps:
        d += s
        ds.append(d)
    df = from_tuples(spark, [(0, i * 1000, x) for i, x in enumerate(ds)], "car int, t long, d long") \
        .withColumn("ts", F.timestamp_micros("t"))
    got = sorted(r.seq for r in delta_trigger_fires(df, ["car"], "ts", "seq", "d", thr, n_blocks=n_blocks).collect())
    assert got == sequential(ds, thr)
