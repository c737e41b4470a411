import random

import pytest
from pyspark.sql import functions as F

from fixtures import SESSION_ROWS
from tidepool.functions.fixed import SESSION_GAP_MS
from tidepool.operators.prefix import blocked_running_totals, range_block
from tidepool.operators.session import session_windows
from tidepool.operators.time_window import sliding_window_agg
from tidepool.sources.records import from_tuples


def session_df(spark):
    return from_tuples(spark, SESSION_ROWS, "key string, t_ms long, value int") \
        .withColumn("ts", F.timestamp_millis("t_ms"))


@pytest.mark.parametrize("n_blocks", [1, 4, 16])
def test_session_golden(spark, n_blocks):
    out = session_windows(session_df(spark), ["key"], "ts", SESSION_GAP_MS * 1000, {"sum": F.sum("value")},
                          first_fields=["t_ms"], tiebreak=["seq"], n_blocks=n_blocks)
    got = sorted((r.key, r.first_t_ms, r.sum) for r in out.collect())
    assert got == [("a", 1, 1), ("a", 10, 1), ("b", 1, 6), ("b", 16, 1), ("c", 6, 1), ("c", 11, 1), ("d", 11, 1)]


def brute_sessions(rows, gap):
    out = {}
    for k in {r[0] for r in rows}:
        ts = sorted(r[1] for r in rows if r[0] == k)
        start = ts[0]
        prev = ts[0]
        n = 1
        for t in ts[1:]:
            if t - prev > gap:
                out[(k, start)] = (prev + gap, n)
                start, n = t, 0
            prev = t
            n += 1
        out[(k, start)] = (prev + gap, n)
    return out


def test_sessions_match_brute_force_with_a_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}", rnd.randrange(0, 200_000), 1)
            for _ in range(3000)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())
    df = from_tuples(spark, rows, "key string, t long, value int").withColumn("ts", F.timestamp_micros("t"))
    out = session_windows(df, ["key"], "ts", 150, {"n": F.count(F.lit(1))}, n_blocks=37)
    got = {}
    for r in out.select("key", F.unix_micros("session_start").alias("s"), F.unix_micros("session_end").alias("e"),
                        "n").collect():
        got[(r.key, r.s)] = (r.e, r.n)
    assert got == brute_sessions(rows, 150)


@pytest.mark.parametrize("strategy", ["expand", "panes"])
def test_sliding_windows_every_row_in_size_over_slide_windows(spark, strategy):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3), rnd.randrange(0, 100_000)) for _ in range(500)]
    df = from_tuples(spark, rows, "key int, t long").withColumn("ts", F.timestamp_micros("t"))
    out = sliding_window_agg(df, ["key"], "ts", 2500, 500, {"n": ("count", F.lit(1))}, strategy)
    assert out.agg(F.sum("n")).first()[0] == 5 * len(rows)
    for r in out.select("key", F.unix_micros("window_start").alias("s"), "n").collect():
        assert r.n == sum(1 for k, t in rows if k == r.key and r.s <= t < r.s + 2500)


def test_pane_and_expand_plans_agree(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(4), rnd.randrange(0, 1_000_000), rnd.randrange(100)) for _ in range(2000)]
    df = from_tuples(spark, rows, "key int, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    aggs = {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    a = sliding_window_agg(df, ["key"], "ts", 60_000, 4_000, aggs, "expand")
    b = sliding_window_agg(df, ["key"], "ts", 60_000, 4_000, aggs, "panes")
    assert sorted(a.collect()) == sorted(b.collect())


def test_tumbling_is_slide_equal_size(spark):
    df = from_tuples(spark, [(1, 0), (1, 999), (1, 1000)], "key int, t long").withColumn("ts", F.timestamp_micros("t"))
    out = sliding_window_agg(df, ["key"], "ts", 1000, 1000, {"n": ("count", F.lit(1))})
    assert sorted(r.n for r in out.collect()) == [1, 2]


def test_blocked_running_totals_match_window_on_skewed_keys(spark):
    rnd = random.Random(11)
    rows = [("hot" if rnd.random() < 0.5 else None if rnd.random() < 0.05 else f"k{rnd.randrange(30)}",
             i, rnd.randrange(10)) for i in range(4000)]
    df = from_tuples(spark, rows, "key string, o long, v long")
    out = blocked_running_totals(df, ["key"], [F.col("o")], range_block(df, F.col("o"), 23, 1),
                                 {"rs": F.col("v"), "rn": F.lit(1).cast("long")})
    got = {r.o: (r.rs, r.rn) for r in out.collect()}
    acc = {}
    for k, o, v in rows:
        s, n = acc.get(k, (0, 0))
        acc[k] = (s + v, n + 1)
        assert got[o] == acc[k]
    assert len(got) == len(rows)


def test_session_fields_are_of_the_first_arrived_record(spark):
    from tidepool.operators.session import session_windows

    rows = [("k", 0, 30, "x"), ("k", 1, 10, "y"), ("k", 2, 20, "z"), ("k", 3, 500, "u"), ("k", 4, 500, "v")]
    df = spark.createDataFrame(rows, "key string, seq long, s long, f string").withColumn("ts", F.timestamp_seconds("s"))
    for n_blocks in (1, 7):
        out = session_windows(df, ["key"], "ts", 60 * 10**6, {"n": F.count(F.lit(1))}, ["f"], ["seq"],
                              n_blocks=n_blocks, first_by=["seq"])
        assert sorted((r.first_f, r.n) for r in out.collect()) == [("u", 2), ("x", 3)]


def test_panes_and_no_windows_cross_the_exchanges(spark):
    df = from_tuples(spark, [("k", 0)], "key string, t long").withColumn("ts", F.timestamp_micros("t"))
    out = sliding_window_agg(df, ["key"], "ts", 60_000, 4_000, {"n": ("count", F.lit(1))}, "panes")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "sequence(" in plan.split("Exchange")[0]


@pytest.mark.parametrize("size,slide", [(60, 4), (50, 20), (7, 7)])
def test_pane_windows_with_odd_rows_and_block_edges(spark, size, slide):
    rnd = random.Random(size)
    some = lambda v: None if rnd.random() < 0.1 else v
    rows = [(some(rnd.choice("ab")), some(rnd.choice([rnd.randrange(-90, 90), rnd.randrange(5000)])), some(rnd.randrange(9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "key string, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    aggs = {"n": ("count", F.col("v")), "s": ("sum", F.col("v").cast("decimal(9,2)")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    a = sliding_window_agg(df, ["key"], "ts", size, slide, aggs, "expand")
    b = sliding_window_agg(df, ["key"], "ts", size, slide, aggs, "panes")
    as_text = lambda d: sorted(map(str, d.collect()))
    assert as_text(a.withColumn("s", F.col("s").cast("double"))) == as_text(b.withColumn("s", F.col("s").cast("double")))
