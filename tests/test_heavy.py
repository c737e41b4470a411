"""Heavy keys are cut into blocks, light ones stay whole: same rows on both sides."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidepool.operators import prefix, rolling, session
from tidepool.operators.rolling import rolling_sums
from tidepool.sources.records import from_tuples

SF = "/root/testdata/sf0.01"


def table(spark, n=2000):
    rnd = random.Random(n)
    rows = [("hot" if rnd.random() < 0.4 else None if rnd.random() < 0.2 else f"k{rnd.randrange(40)}", i, rnd.choice([None, 1, 5, -3])) for i in range(n)]
    return rows, from_tuples(spark, rows, "key string, o long, v long")


def brute(rows, exclusive=False):
    seen, out = {}, {}
    for k, o, v in rows:
        total, top, n = seen.get(k, (None, None, 0))
        new = (total if v is None else (total or 0) + v, top if v is None else v if top is None else max(top, v), n + 1)
        out[o] = (total, top, n) if exclusive else new
        seen[k] = new
    return out


@pytest.mark.parametrize("least", [1, 300, 10**6])       # null and hot heavy, hot heavy, none
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_totals_on_both_sides(spark, monkeypatch, least, exclusive):
    rows, df = table(spark)
    found = []
    real = prefix.heavy_keys
    monkeypatch.setattr(rolling, "heavy_keys", lambda d, k: found.append(real(d, k, least)) or found[-1])
    out = rolling_sums(df, ["key"], ["o"], {"s": F.col("v"), "m": ("max", F.col("v")), "n": F.lit(1).cast("long")}, min_rows_per_block=50, exclusive=exclusive)
    got = {r.o: (r.s, r.m, r.n or 0) for r in out.collect()}
    assert got == brute(rows, exclusive)
    heavy = found[0][0]
    assert sorted(str(r.key) for r in heavy.collect()) if heavy is not None else [] == {1: ["None", "hot"], 300: ["hot"], 10**6: []}[least]


@pytest.mark.parametrize("least", [1, 300, 10**6])
def test_sessions_on_both_sides(spark, monkeypatch, least):
    rows, df = table(spark)
    df = df.withColumn("ts", F.timestamp_micros(F.col("o") * 1000 + F.col("o") * 7919 % 5000))
    real = prefix.heavy_keys
    args = (["key"], "ts", 9000, {"n": F.count(F.lit(1)), "s": F.sum("v")}, ["o"], ["o"])
    want = session.session_windows(df, *args, n_blocks=1)
    monkeypatch.setattr(session, "heavy_keys", lambda d, k: real(d, k, least))
    got = session.session_windows(df, *args, min_rows_per_block=50)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_key_alone_is_cut_without_a_light_part(spark, monkeypatch):
    df = from_tuples(spark, [("a", i, 1) for i in range(500)], "key string, o long, v long")
    heavy, others = prefix.heavy_keys(df, ["key"], 100)
    assert [r.key for r in heavy.collect()] == ["a"] and not others
    assert prefix.heavy_keys(df.limit(0), ["key"], 100) == (None, True)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_of_a_hot_key(spark):
    p = physical(E.queries()["session_window_sum_hot"](spark, SF))
    assert re.search(r"lag\(_t#\d+L?, -?1, null\) windowspecdefinition\(_key#\d+, _blk#\d+L", p)
    assert "MergingSessions" in p or "session_window" in p
    p = physical(E.queries()["count_window_sum_hot"](spark, SF))
    assert re.search(r"windowspecdefinition\(_key#\d+, _blk#\d+L", p) and "partial_sum" in p


def test_plan_without_hot_keys(spark):
    p = physical(E.queries()["session_window_sum"](spark, SF))
    assert "_blk" not in p and "session_window" in p


def test_gate_covers_several_blocks(spark):
    """The car queries of the gate run over several blocks per car."""
    from tidepool.plans import event_jobs as J

    tel = J.telemetry(spark, SF)
    blk = prefix.range_block(tel, F.unix_micros("ts"), 32)
    assert tel.select(blk.alias("b")).distinct().count() >= 4
    assert prefix.heavy_keys(tel, ["car_id"])[0].count() == 8


@pytest.mark.parametrize("edges", [4, 1000])
def test_edges_as_tests_and_as_a_search_agree(spark, monkeypatch, edges):
    df = spark.range(3000).select((F.col("id") * 37 % 5000).alias("o"))
    want = [r.b for r in df.select(prefix.range_block(df, F.col("o"), 300, 1).alias("b")).collect()]
    monkeypatch.setattr(prefix, "TREE_EDGES", edges)
    assert [r.b for r in df.select(prefix.range_block(df, F.col("o"), 300, 1).alias("b")).collect()] == want
