"""Watermarks and late rows per record, against a loop over the arrivals."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.late import late_rows, with_watermark_column
from tidepool.plans import event_jobs as J

GAP, LAG = 10, 16


def plain(rows):
    top, sessions, out = None, {}, {}
    for key, o, t in rows:
        mark = None if top is None else top - LAG
        late = False
        if t is not None:
            live = [s for s in sessions.get(key, []) if mark is None or s[1] - 1 > mark]
            met = [s for s in live if s[0] <= t + GAP and s[1] >= t]
            new = (min([t] + [s[0] for s in met]), max([t + GAP] + [s[1] for s in met]))
            late = mark is not None and new[1] - 1 <= mark
            sessions[key] = live if late else [s for s in live if s not in met] + [new]
            top = t if top is None else max(top, t)
        out[o] = (mark, late)
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("n_blocks", [None, 13])
def test_late_rows_equal_a_loop(spark, seed, n_blocks):
    rnd = random.Random(seed)
    dense = seed % 2                 # sessions that stay open, or many short ones
    rows = [(rnd.choice(["hot", "hot", None, "a", "b"]) if dense else f"k{rnd.randrange(30)}", i,
             None if rnd.random() < 0.01 else 3 * i + rnd.choice([0, 0, 0, -12, -30, -45, -200])) for i in range(900)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "key string, o long, t long, _x string, late_ int")
    got = {r.o: (r.watermark, r.late) for r in late_rows(df, ["key"], ["o"], "t", GAP, LAG, n_blocks=n_blocks).collect()}
    want = plain(rows)
    assert got == want
    own = [o for _, o, t in rows if t is not None and want[o][0] is not None and t + GAP - 1 <= want[o][0]]
    saved = [o for o in own if not want[o][1]]
    assert any(v[1] for v in want.values()) and (saved or not dense)


def test_watermark_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 4), (4, None), (5, 9)], "o long, t long")
    out = with_watermark_column(df, ["o"], "t", 2, n_blocks=3)
    assert [r.watermark for r in out.orderBy("o").collect()] == [None, None, 3, 3, 3]
    assert with_watermark_column(df.limit(0), ["o"], "t", 2).count() == 0


def test_the_gate_has_late_and_saved_rows(spark):
    out = J.late_rows_exact_hot(spark, "/root/testdata/sf0.01")
    own = F.col("t_ms") + J.LATE_GAP_MS - 1 <= F.col("watermark")
    n = out.agg(F.sum(F.col("late").cast("int")).alias("late"), F.sum((own & ~F.col("late")).cast("int")).alias("saved")).first()
    assert n.late > 100 and n.saved > 100
