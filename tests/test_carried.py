"""Batch operators on streams with carried rows: equal to the batch form, for any
cut into batches, with hot keys and with a repeated batch."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import TELEMETRY
from tidepool.functions.fixed import TOP_SPEED_EVICTION_SEC, TOP_SPEED_TRIGGER_METERS
from tidepool.operators import rolling
from tidepool.operators import prefix
from tidepool.operators.count_window import count_window
from tidepool.operators.reduce import rolling_reduce, window_reduce
from tidepool.operators.user_functions import flat_map, map_records
from tidepool.session import scratch_path
from tidepool.sources.records import from_tuples
from tidepool.streaming import carried as C
from tidepool.streaming.counts import count_window_batches
from tidepool.streaming.replay import replay


def run(spark, df, order, n_batches, make):
    out = scratch_path(spark, "t-out")
    fn = make(scratch_path(spark, "t-state"), lambda d, i: d.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))

    def twice(batch, batch_id):
        fn(batch, batch_id)
        if batch_id % 2:
            fn(batch, batch_id)

    replay(df, F.col(order), n_batches, lambda s: s.writeStream.foreachBatch(twice), "t")
    return spark.read.parquet(out).drop("batch_id")


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


@pytest.fixture
def skewed(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice([None, "a", "b", "c", "d"]), rnd.choice([None, 1, 7, -4])) for _ in range(600)]
    real = prefix.heavy_keys
    monkeypatch.setattr(rolling, "heavy_keys", lambda d, k: real(d, k, 20))
    return from_tuples(spark, rows, "key string, v long")


@pytest.mark.parametrize("size,slide", [(10, 5), (3, 7), (1, 1)])
def test_count_windows_of_values(spark, skewed, size, slide):
    got = run(spark, skewed, "seq", 4, lambda st, sk: C.count_value_batches("key", ["seq"], F.col("v"), size, slide, st, sk))
    want = count_window(skewed, ["key"], ["seq"], size, slide, F.col("v"), n_blocks=1)
    assert rows_of(got) == rows_of(want)


def test_counts(spark, skewed):
    got = run(spark, skewed, "seq", 4, lambda st, sk: count_window_batches("key", ["seq"], 6, 2, st, sk))
    assert rows_of(got) == rows_of(count_window(skewed, ["key"], ["seq"], 6, 2, n_blocks=1))


def test_rolling_reduce(spark, skewed):
    best = F.struct(F.col("v").alias("top"), F.col("seq").alias("at"))

    def later(a, b):
        return F.when(b["top"] > a["top"], b).otherwise(a)

    src = skewed.where("v IS NOT NULL")
    got = run(spark, src, "seq", 3, lambda st, sk: C.rolling_reduce_batches("key", ["seq"], best, later, st, sk, "best"))
    assert rows_of(got) == rows_of(rolling_reduce(src, ["key"], ["seq"], best, later, "best", n_blocks=1))


def test_windows_from_pane_folds(spark, skewed):
    src = skewed.withColumn("ts", F.timestamp_micros(F.col("seq") * 7))
    parts = run(spark, src, "seq", 3, lambda st, sk: C.pane_reduce_batches(["key"], "ts", 50, F.col("v"), F.greatest, sk))
    got = C.merge_panes(parts, ["key"], 250, 50, F.greatest)
    assert rows_of(got) == rows_of(window_reduce(src, ["key"], "ts", 250, 50, F.col("v"), F.greatest))


@pytest.mark.parametrize("n_batches", [1, 3, 6])
def test_top_speed_golden(spark, n_batches):
    far = [int(d * 360) for _, d, _ in TELEMETRY]
    steps = [far[0]] + [b - a for a, b in zip(far, far[1:])]
    df = from_tuples(spark, [(1, t, inc, float(s)) for (s, _, t), inc in zip(TELEMETRY, steps)], "car_id int, t_ms long, speed_c long, speed double") \
        .withColumn("ts", F.timestamp_millis("t_ms"))
    got = run(spark, df, "seq", n_batches, lambda st, sk: C.top_speed_batches(
        "car_id", "ts", "seq", "speed_c", "speed", int(TOP_SPEED_TRIGGER_METERS * 360), TOP_SPEED_EVICTION_SEC * 1_000_000, st, sk))
    assert sorted((r.fire_seq, r.top_speed, r.ms) for r in got.withColumn("ms", F.unix_millis("top_ts")).collect()) == [(2, 90.0, 1000), (3, 90.0, 12000), (5, 90.0, 12000)]


def test_user_functions(spark):
    df = from_tuples(spark, [("a b",), (None,), ("",), ("c",)], "text string")
    out = flat_map(df, lambda t: [(w, len(w)) for w in (t or "").split()], ["text"], "word string, n int")
    assert sorted((r.seq, r.word, r.n) for r in out.collect()) == [(0, "a", 1), (0, "b", 1), (3, "c", 1)]
    assert [r.n for r in map_records(df, lambda p: p[["seq"]].assign(n=p["seq"] * 2), "seq long, n long").orderBy("seq").collect()] == [0, 2, 4, 6]
    with pytest.raises(Exception, match="one record for every record"):
        map_records(df.coalesce(1), lambda p: p[:1][["seq"]], "seq long").collect()


def test_lines_of_streamed_files_are_numbered(spark):
    from tidepool.sources.records import numbered_lines

    df = from_tuples(spark, [(f"line {i}",) for i in range(500)], "text string")
    out = scratch_path(spark, "t-lines")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        replay(df, F.col("seq"), 2, lambda s: s.writeStream.foreachBatch(lambda b, i: numbered_lines(b).write.mode("overwrite").parquet(f"{out}/batch_id={i}")),
               "t-lines", lines=("text", "seq"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = spark.read.parquet(out).orderBy("batch_id", "line_no").collect()
    assert [r.line for r in rows] == [f"line {i}" for i in range(500)] and [r.line_no for r in rows] == [*range(250), *range(250)]
    assert len({(r.batch_id, r.line_start) for r in rows}) > 4
