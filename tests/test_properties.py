"""Property tests against plain-Python folds (random data, parameters and
block counts)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators.count_window import count_window
from tidepool.operators.session import session_windows
from tidepool.sources.records import from_tuples

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 400), st.integers(-5, 9)),
                  min_size=1, max_size=120)


@SETTINGS
@given(rows=events, gap=st.integers(0, 40), n_blocks=st.integers(1, 9))
def test_sessions(spark, rows, gap, n_blocks):
    df = from_tuples(spark, rows, "k string, t long, v long").withColumn("ts", F.timestamp_micros("t"))
    out = session_windows(df, ["k"], "ts", gap, {"s": F.sum("v"), "n": F.count(F.lit(1))}, tiebreak=["seq"],
                          n_blocks=n_blocks)
    got = sorted((r.k, r.st, r.en, r.s, r.n) for r in out.select(
        "k", F.unix_micros("session_start").alias("st"), F.unix_micros("session_end").alias("en"), "s", "n").collect())
    exp = []
    for k in sorted({r[0] for r in rows}):
        pts = sorted((t, v) for kk, t, v in rows if kk == k)
        start, last, s, n = pts[0][0], pts[0][0], 0, 0
        for t, v in pts:
            if t - last > gap:
                exp.append((k, start, last + gap, s, n))
                start, s, n = t, 0, 0
            last, s, n = t, s + v, n + 1
        exp.append((k, start, last + gap, s, n))
    assert got == sorted(exp)


@SETTINGS
@given(rows=events, size=st.integers(1, 12), slide=st.integers(1, 6), n_blocks=st.integers(1, 9),
       strategy=st.sampled_from(["expand", "prefix"]))
def test_count_windows(spark, rows, size, slide, n_blocks, strategy):
    df = from_tuples(spark, rows, "k string, t long, v long")
    out = count_window(df, ["k"], ["t", "seq"], size, slide, F.col("v"), n_blocks=n_blocks, strategy=strategy)
    got = sorted((r.k, r.seq_in_key, r.n) for r in out.collect())
    exp = []
    for k in sorted({r[0] for r in rows}):
        vals = [v for _, _, v in sorted((t, i, v) for i, (kk, t, v) in enumerate(rows) if kk == k)]
        exp += [(k, i, sum(vals[max(0, i - size):i])) for i in range(1, len(vals) + 1) if i % slide == 0]
    assert got == sorted(exp)
