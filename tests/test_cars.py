import random

import pytest
from pyspark.sql import functions as F

from fixtures import TELEMETRY
from tidepool.functions.fixed import TOP_SPEED_EVICTION_SEC, TOP_SPEED_TRIGGER_METERS
from tidepool.operators.delta import delta_trigger_fires
from tidepool.operators.trailing import max_by_record, trailing_time_max
from tidepool.sources.records import from_elements, from_tuples, parse_telemetry


def car_df(spark, rows=TELEMETRY):
    return (from_tuples(spark, [(1, *r) for r in rows], "car_id int, speed int, distance double, ts_ms long")
            .withColumn("ts", F.timestamp_millis("ts_ms")))


@pytest.mark.parametrize("n_blocks", [1, 3])
def test_delta_trigger_golden(spark, n_blocks):
    fires = delta_trigger_fires(car_df(spark), ["car_id"], "ts", "seq", "distance", 50.0, n_blocks=n_blocks)
    assert sorted(r.seq for r in fires.collect()) == [2, 3, 5]


def test_top_speed_golden(spark):
    df = car_df(spark)
    tops = trailing_time_max(df, ["car_id"], "ts", TOP_SPEED_EVICTION_SEC * 1_000_000, "speed",
                             ["speed", "ts_ms", "seq"], ["seq"])
    fires = delta_trigger_fires(df, ["car_id"], "ts", "seq", "distance", TOP_SPEED_TRIGGER_METERS) \
        .select("car_id", "seq")
    got = sorted((r.seq, r.top_speed, r.top_ts_ms) for r in tops.join(fires, ["car_id", "seq"], "left_semi").collect())
    assert got == [(2, 90, 1000), (3, 90, 12000), (5, 90, 12000)]


def brute_fires(rows, thr):
    out, ref = [], None
    for car in sorted({r[0] for r in rows}):
        ref = None
        for seq, (c, t, d) in sorted(((i, r) for i, r in enumerate(rows) if r[0] == car), key=lambda x: (x[1][1], x[0])):
            if ref is None:
                ref = d
            elif d - ref > thr:
                out.append(seq)
                ref = d
    return sorted(out)


@pytest.mark.parametrize("n_blocks", [1, 5, 40])
def test_blocked_fold_matches_sequential_fold(spark, n_blocks):
    rnd = random.Random(n_blocks)
    rows, dist = [], {}
    for i in range(3000):
        car = 0 if rnd.random() < 0.6 else rnd.randrange(1, 4)   # one hot car
        dist[car] = dist.get(car, 0) + rnd.choice([0, 0, 3, 17, 40, 55, 120])
        rows.append((car, i * 10, dist[car]))
    df = from_tuples(spark, rows, "car_id int, t long, d long").withColumn("ts", F.timestamp_micros("t"))
    got = delta_trigger_fires(df, ["car_id"], "ts", "seq", "d", 100, n_blocks=n_blocks)
    assert sorted(r.seq for r in got.collect()) == brute_fires(rows, 100)


def test_decreasing_measure_is_rejected(spark):
    df = car_df(spark, [(50, 10.0, 0), (50, 5.0, 1000)])
    with pytest.raises(Exception):
        delta_trigger_fires(df, ["car_id"], "ts", "seq", "distance", 1.0).collect()


def test_trailing_max_is_strict_and_blocked(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(2), i * 7, rnd.randrange(5)) for i in range(600)]
    df = from_tuples(spark, rows, "car_id int, t long, speed int").withColumn("ts", F.timestamp_micros("t"))
    out = trailing_time_max(df, ["car_id"], "ts", 70, "speed", ["seq"], ["seq"], n_blocks=25).collect()
    for r in out:
        c, t, _ = rows[r.seq]
        frame = [(s, i) for i, (cc, tt, s) in enumerate(rows) if cc == c and t - 70 < tt <= t]
        best = max(s for s, _ in frame)
        assert r.top_seq == min(i for s, i in frame if s == best)


def test_max_by_record_earliest_on_ties(spark):
    df = car_df(spark)
    r = max_by_record(df, ["car_id"], "speed", ["seq", "ts_ms"], "ts", ["seq"]).first()
    assert (r.seq, r.ts_ms) == (1, 1000)


def test_parse_telemetry_strict_and_permissive(spark):
    ok = from_elements(spark, ["(1,50,13.9,1000)"], "line")
    r = parse_telemetry(ok).first()
    assert (r.car_id, r.speed, r.distance, r.ts_ms) == (1, 50, 13.9, 1000)
    bad = from_elements(spark, ["(1,x,13.9,1000)"], "line")
    with pytest.raises(Exception):
        parse_telemetry(bad).collect()
    assert parse_telemetry(bad, strict=False).first().parse_ok is False


def test_trailing_max_at_fires_golden(spark):
    from tidepool.operators.trailing import trailing_max_at

    df = car_df(spark)
    fires = delta_trigger_fires(df, ["car_id"], "ts", "seq", "distance", TOP_SPEED_TRIGGER_METERS)
    out = trailing_max_at(fires, df, ["car_id"], "ts", "seq", TOP_SPEED_EVICTION_SEC * 1_000_000, "speed",
                          ["speed", "ts_ms", "seq"])
    assert sorted((r.seq, r.top_speed, r.top_ts_ms) for r in out.collect()) == \
        [(2, 90, 1000), (3, 90, 12000), (5, 90, 12000)]


def test_trailing_max_at_orders_equal_timestamps_by_arrival(spark):
    from tidepool.operators.trailing import trailing_max_at

    rnd = random.Random(9)
    rows = [(rnd.randrange(2), rnd.randrange(0, 60) * 10, rnd.randrange(6)) for _ in range(400)]  # many equal ts
    df = from_tuples(spark, rows, "car_id int, t long, speed int").withColumn("ts", F.timestamp_micros("t"))
    points = df.where(F.col("seq") % 7 == 0)
    out = trailing_max_at(points, df, ["car_id"], "ts", "seq", 50, "speed", ["seq"]).collect()
    assert len(out) == len([i for i in range(len(rows)) if i % 7 == 0])
    for r in out:
        c, t, _ = rows[r.seq]
        frame = [(s, tt, i) for i, (cc, tt, s) in enumerate(rows)
                 if cc == c and t - 50 < tt <= t and (tt < t or i <= r.seq)]
        best = max(s for s, _, _ in frame)
        assert r.top_seq == min((tt, i) for s, tt, i in frame if s == best)[1]


def test_trailing_max_pane_plan_exact_with_equal_timestamps(spark):
    rnd = random.Random(12)
    rows = [(rnd.randrange(2), rnd.randrange(0, 80) * 5, rnd.randrange(6)) for _ in range(700)]
    df = from_tuples(spark, rows, "car_id int, t long, speed int").withColumn("ts", F.timestamp_micros("t"))
    out = trailing_time_max(df, ["car_id"], "ts", 60, "speed", ["seq", "speed"], ["seq"], strategy="panes")
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        c, t, _ = rows[r.seq]
        frame = [(s, tt, i) for i, (cc, tt, s) in enumerate(rows)
                 if cc == c and t - 60 < tt <= t and (tt < t or i <= r.seq)]
        best = max(s for s, _, _ in frame)
        assert r.top_seq == min((tt, i) for s, tt, i in frame if s == best)[1]


def test_trailing_max_plans_agree_on_unique_timestamps(spark):
    rnd = random.Random(13)
    rows = [(rnd.randrange(3), i * 3 + rnd.randrange(3), rnd.randrange(9)) for i in range(900)]
    df = from_tuples(spark, rows, "car_id int, t long, speed int").withColumn("ts", F.timestamp_micros("t"))
    a = trailing_time_max(df, ["car_id"], "ts", 40, "speed", ["seq"], ["seq"], strategy="frame", n_blocks=7)
    b = trailing_time_max(df, ["car_id"], "ts", 40, "speed", ["seq"], ["seq"], strategy="panes")
    assert sorted((r.seq, r.top_seq) for r in a.collect()) == sorted((r.seq, r.top_seq) for r in b.collect())


def test_sequential_delta_fold_handles_any_measure(spark):
    from tidepool.operators.delta import delta_trigger_fires_sequential

    rnd = random.Random(21)
    rows = [(rnd.randrange(3), i * 10, rnd.randrange(-40, 60)) for i in range(600)]   # not monotone
    df = from_tuples(spark, rows, "car_id int, t long, d long").withColumn("ts", F.timestamp_micros("t"))
    got = delta_trigger_fires_sequential(df, ["car_id"], "ts", "seq", "d", 30, n_slices=4)
    assert sorted(r.seq for r in got.collect()) == brute_fires(rows, 30)


@pytest.mark.parametrize("n_blocks", [1, 6])
def test_delta_references_are_exact_integers(spark, n_blocks):
    rows = [("k", i, 2**53 + i) for i in range(6)]
    df = spark.createDataFrame(rows, "key string, seq long, d long").withColumn("ts", F.timestamp_seconds("seq"))
    for threshold, want in ((0, [1, 2, 3, 4, 5]), (1.5, [2, 4])):
        out = delta_trigger_fires(df, ["key"], "ts", "seq", "d", threshold, n_blocks=n_blocks)
        assert sorted(r.seq for r in out.collect()) == want


def test_trailing_max_at_work_is_linear(spark):
    """Points never meet the records of their span in pairs (a join)."""
    from tidepool.operators.trailing import trailing_max_at

    df = from_tuples(spark, [(0, 0, 3)] * 50, "car_id int, t long, speed int").withColumn("ts", F.timestamp_micros("t"))
    out = trailing_max_at(df, df, ["car_id"], "ts", "seq", 100, "speed", ["seq", "speed"], full_rows=False)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.top_seq for r in out.collect()} == {0}


def test_trailing_max_at_odd_rows(spark):
    from tidepool.operators.trailing import trailing_max_at

    rnd = random.Random(4)
    some = lambda v: None if rnd.random() < 0.1 else v
    recs = [(some(rnd.randrange(2)), some(i // 2), some(rnd.randrange(-40, 40)), some(rnd.randrange(5))) for i in range(300)]
    df = spark.createDataFrame(recs, "car int, seq long, t long, v int").withColumn("ts", F.timestamp_micros("t"))
    points = df.where("v = 3 or v is null")
    got = trailing_max_at(points, df, ["car"], "ts", "seq", 15, "v", ["t", "v"], full_rows=False)
    want = {}
    for car, seq, t, v in recs:
        if t is None or not (v == 3 or v is None):
            continue
        for c, s, u, x in recs:
            if c == car and u is not None and t - 15 < u and (u < t or (u == t and None not in (s, seq) and s <= seq)):
                rank = ((0, 0) if x is None else (1, x), -u, (0, 0) if s is None else (1, -s))
                want[car, seq] = max(want.get((car, seq), (rank, u, x)), (rank, u, x), key=lambda r: r[0])
    assert {((r.car, r.seq), r.top_t, r.top_v) for r in got.collect()} == {(k, u, x) for k, (_, u, x) in want.items()}


def test_trailing_time_max_panes_does_the_whole_job(spark, tmp_path):
    """Odometer, distance and time of the fastest record, as in trailing_time_max."""
    from tidepool.plans import registry

    rows = [(i, i * 1_200, i % 3, float(i * 37 % 50)) for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, s long, user_id long, value double")
    events.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "value").write.parquet(f"{tmp_path}/events.parquet")
    q = registry.queries()
    a, b = (q[n](spark, str(tmp_path)) for n in ("trailing_time_max", "trailing_time_max_panes"))
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert registry.oracle_sql()["trailing_time_max_panes"] == registry.oracle_sql()["trailing_time_max"]
