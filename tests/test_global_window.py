"""Any trigger with any evictor, and the general delta fold, against plain loops."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators.delta_any import chain_ends, change_fires, successors
from tidepool.operators.global_window import Count, Delta, Span, global_window
from tidepool.sources.records import from_tuples


def plain_fires(values, threshold, kind):
    ref, out = None, []
    for i, v in enumerate(values):
        if ref is None:
            ref = v
        elif (abs(v - ref) if kind == "distance" else v - ref) > threshold:
            out.append(i)
            ref = v
    return out


@settings(max_examples=150, deadline=None)
@given(values=st.lists(st.integers(-30, 30), min_size=1, max_size=80), threshold=st.integers(-5, 40), kind=st.sampled_from(["difference", "distance"]))
def test_successors(values, threshold, kind):
    d = np.array(values)
    nxt = successors(d, threshold, kind)
    for i, v in enumerate(values):
        far = [j for j in range(i + 1, len(values)) if (abs(values[j] - v) if kind == "distance" else values[j] - v) > threshold]
        assert nxt[i] == (far[0] if far else len(values))
    i, fires = 0, []
    while nxt[i] < len(d):
        i = int(nxt[i])
        fires.append(i)
    assert fires == plain_fires(values, threshold, kind) and chain_ends(nxt)[0] == i


def walk(kind, n, rnd):
    if kind == "rising":
        return list(np.cumsum([rnd.choice([0, 0, 7, 30]) for _ in range(n)]))
    if kind == "noise":
        return [rnd.randrange(-100, 100) for _ in range(n)]
    if kind == "flat":
        return [5] * n
    return list(np.cumsum([rnd.choice([-9, -4, 0, 4, 9]) for _ in range(n)]))


@pytest.mark.parametrize("shape", ["rising", "noise", "drift", "flat"])
@pytest.mark.parametrize("kind", ["difference", "distance"])
@pytest.mark.parametrize("n_blocks", [None, 1, 24])
def test_change_fires_equal_a_loop(spark, shape, kind, n_blocks):
    rnd = random.Random(f"{shape}{kind}")
    rows, values = [], {}
    for car, n in ((0, 1500), (1, 120), (2, 1)):
        values[car] = walk(shape, n, rnd)
        rows += [(car, i, int(v)) for i, v in enumerate(values[car])]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "car int, o long, d long")
    threshold = 25 if shape != "drift" else 11
    got = {}
    for r in change_fires(df, ["car"], ["o"], "d", threshold, kind, n_blocks=n_blocks, min_rows_per_block=100).collect():
        got.setdefault(r.car, []).append(r.o)
        assert values[r.car][r.o] == r.d
    assert {c: sorted(v) for c, v in got.items()} == {c: f for c, v in values.items() if (f := plain_fires(v, threshold, kind))}


def test_change_fires_of_floats_and_negative_thresholds(spark):
    rnd = random.Random(5)
    values = [rnd.gauss(0, 1) * 0.3 for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "o long, d double").withColumn("k", F.lit("x"))
    for threshold, kind in ((0.3, "distance"), (0.3, "difference"), (-0.1, "difference"), (0.0, "distance")):
        got = sorted(r.o for r in change_fires(df, ["k"], ["o"], "d", threshold, kind, n_blocks=17).collect())
        assert got == plain_fires(values, threshold, kind)


def test_missing_measure_is_rejected(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 3.0)], "k int, o long, d double")
    with pytest.raises(Exception, match="must not be NULL"):
        change_fires(df, ["k"], ["o"], "d", 1.0).collect()
    with pytest.raises(ValueError, match="unknown kind"):
        change_fires(df, ["k"], ["o"], "d", 1.0, "ratio")
    assert change_fires(df.limit(0), ["k"], ["o"], "d", 1.0).collect() == []


def arrivals(seed, n=700):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        car = 0 if rnd.random() < 0.6 else rnd.choice([None, 1, 2])
        rows.append((car, i, None if rnd.random() < 0.02 else 40 * i + rnd.randrange(-600, 600), rnd.randrange(100)))
    return rows


def plain_window(rows, trigger, evictor):
    out = []
    for car in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == car]
        fires = [i for i in range(len(mine)) if (i + 1) % trigger.n == 0] if isinstance(trigger, Count) else plain_fires([r[3] for r in mine], trigger.threshold, trigger.kind)
        buffer, done = [], 0
        for f in fires:
            buffer += mine[done : f + 1]
            done = f + 1
            if isinstance(evictor, Count):
                buffer = buffer[-evictor.n :]
            elif any(r[2] is not None for r in buffer):
                top = max(r[2] for r in buffer if r[2] is not None)
                buffer = [r for r in buffer if r[2] is not None and r[2] > top - evictor.span_us]
            kept = [r for r in buffer if isinstance(evictor, Count) or r[2] is not None]
            if kept:
                best = max(kept, key=lambda r: (r[3], -r[1]))
                out.append((car, mine[f][1], f + 1, len(kept), best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n_blocks", [None, 16])
@pytest.mark.parametrize("trigger", [Count(7), Delta("v", 30), Delta("v", 40, "distance")])
@pytest.mark.parametrize("evictor", [Count(5), Count(60), Span("ts", 900)])
def test_trigger_and_evictor_equal_a_buffer(spark, trigger, evictor, n_blocks):
    rows = arrivals(3)
    df = spark.createDataFrame(rows, "car int, o long, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    out = global_window(df, ["car"], ["o"], trigger, evictor,
                        {"n": F.count(F.lit(1)), "best": F.max_by("o", F.struct(F.col("v"), -F.col("seq_in_key")))}, n_blocks=n_blocks)
    assert sorted(map(tuple, out.collect()), key=str) == plain_window(rows, trigger, evictor)


def test_window_shape_is_checked(spark):
    df = from_tuples(spark, [(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        global_window(df, ["k"], ["seq"], Count(0), Count(3), {"n": F.count(F.lit(1))})


@pytest.mark.parametrize("trigger", [Count(7), Delta("v", 30)])
@pytest.mark.parametrize("span", [1, 90, 900, 5000])
def test_folded_spans_equal_a_buffer(spark, trigger, span):
    rows = arrivals(5)
    df = spark.createDataFrame(rows, "car int, o long, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    aggs = {"n": ("count", F.lit(1)), "best": ("max_by", F.col("o"), F.struct(F.col("v"), -F.col("seq_in_key")))}
    out = global_window(df, ["car"], ["o"], trigger, Span("ts", span), aggs)
    assert sorted(map(tuple, out.collect()), key=str) == plain_window(rows, trigger, Span("ts", span))
    more = {"s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v")), "some": ("count", F.col("v"))}
    plain = {"s": F.sum("v"), "lo": F.min("v"), "hi": F.max("v"), "some": F.count("v")}
    a, b = (global_window(df, ["car"], ["o"], trigger, Span("ts", span), m) for m in (more, plain))
    assert a.dtypes == b.dtypes and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_fires_and_records_of_a_span_make_no_pairs(spark):
    rows = [(1, i, 0, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "car int, o long, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    out = global_window(df, ["car"], ["o"], Count(1), Span("ts", 100), {"n": ("count", F.lit(1)), "s": ("sum", F.col("v"))})
    assert "_b#" not in out._jdf.queryExecution().optimizedPlan().toString()      # the bucket of the join
    assert sorted((r.n, r.s) for r in out.collect()) == [(i, i) for i in range(1, 501)]
