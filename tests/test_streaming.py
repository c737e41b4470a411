import pytest
from pyspark.sql import functions as F

from fixtures import SESSION_ROWS, TELEMETRY, WINDOW_WORDS
from tidepool.functions.fixed import (SESSION_GAP_MS, SESSION_WATERMARK_LAG_MS, TOP_SPEED_EVICTION_SEC,
                                      TOP_SPEED_TRIGGER_METERS)
from tidepool.operators.delta import delta_trigger_fires_sequential
from tidepool.operators.tokenize import tokenize_words
from tidepool.session import scratch_path
from tidepool.sources.records import from_elements, from_tuples
from tidepool.sinks.tuple_text import stream_show, stream_tuple_text
from tidepool.streaming import stateful
from tidepool.streaming.counts import count_window_batches
from tidepool.streaming.replay import dropped_by_watermark, replay, sentinel_row
from tidepool.streaming.windows import stream_session_agg, watermark_delay_for_lag


def sink(df, path):
    return df.writeStream.format("parquet").option("path", path).outputMode("append")


def test_stream_sessions_one_record_per_batch(spark):
    df = from_tuples(spark, SESSION_ROWS, "key string, t_ms long, value int").withColumn("ts", F.timestamp_millis("t_ms"))
    out = scratch_path(spark, "t-sess")
    delay = watermark_delay_for_lag(SESSION_WATERMARK_LAG_MS)
    assert delay == "15 milliseconds"

    def build(stream):
        agg = stream_session_agg(stream, ["key"], "ts", f"{SESSION_GAP_MS} milliseconds", delay,
                                 {"first_t": F.min_by("t_ms", "seq"), "sum": F.sum("value")})
        return sink(agg, out)

    # arrival order = seq; one record per micro-batch, then the end-of-input flush
    replay(df, F.col("seq"), len(SESSION_ROWS), build, "t-sess", sentinel_row(df, "ts", "1 day"))
    got = sorted((r.key, r.first_t, r.sum) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1, 1), ("a", 10, 1), ("b", 1, 6), ("b", 16, 1), ("c", 6, 1), ("c", 11, 1), ("d", 11, 1)]


def test_stream_count_window_matches_batch_golden(spark):
    docs = from_elements(spark, WINDOW_WORDS).withColumnRenamed("seq", "doc_id")
    out = scratch_path(spark, "t-cw")

    def build(stream):
        return sink(stateful.stream_count_window(tokenize_words(stream), "word", ["doc_id", "pos"], 6, 1), out)

    replay(docs, F.col("doc_id"), 4, build, "t-cw")
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 24
    by = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.pos)):
        by.setdefault(r.word, []).append(r.n)
    assert by["bytedance"] == [1, 2, 3, 4, 5] and by["hello"] == [1, 2, 3]


def test_stream_top_speed_golden(spark):
    rows = [(1, int(d * 360), s, t) for s, d, t in TELEMETRY]  # dist in 1/100 km/h*s -> speed_c increments
    # feed increments so the stateful odometer reproduces the fixture distances
    incs = [rows[0][1]] + [rows[i][1] - rows[i - 1][1] for i in range(1, len(rows))]
    df = from_tuples(spark, [(1, t * 1000, inc, float(s)) for (_, _, s, t), inc in zip(rows, incs)],
                     "car_id int, ts_us long, speed_c long, speed double")
    out = scratch_path(spark, "t-top")

    def build(stream):
        return sink(stateful.stream_top_speed(stream, "car_id", "ts_us", "seq", "speed_c", "speed",
                                              int(TOP_SPEED_TRIGGER_METERS * 360),
                                              TOP_SPEED_EVICTION_SEC * 1_000_000), out)

    replay(df, F.col("seq"), 3, build, "t-top")
    got = sorted((r.fire_seq, r.top_speed, r.top_ts_us // 1000) for r in spark.read.parquet(out).collect())
    assert got == [(2, 90.0, 1000), (3, 90.0, 12000), (5, 90.0, 12000)]


def test_late_rows_are_dropped(spark):
    from tidepool.streaming.windows import stream_sliding_agg

    rows = [(0, "k"), (10_000, "k"), (20_000, "k"), (5_000, "k")]   # the last arrives late
    df = from_tuples(spark, rows, "t long, key string").withColumn("ts", F.timestamp_millis("t"))
    out = scratch_path(spark, "t-late")

    def build(stream):
        return sink(stream_sliding_agg(stream, ["key"], "ts", "1 second", "1 second", "0 seconds",
                                       {"n": F.count(F.lit(1))}), out)

    progress = replay(df, F.col("seq"), 4, build, "t-late", sentinel_row(df, "ts", "1 day"))
    got = sorted((r.window_start.second, r.n) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1), (10, 1), (20, 1)]
    assert dropped_by_watermark(progress) == 1


def test_processing_time_windows_close_on_later_batches(spark):
    import time

    from tidepool.streaming.windows import processing_time_sliding

    src, out, ckpt = (scratch_path(spark, n) for n in ("t-pt-src", "t-pt-out", "t-pt-ckpt"))
    schema = "key int, v int"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        agg = processing_time_sliding(spark.readStream.schema(schema).parquet(src), ["key"], "2 seconds",
                                      "1 second", {"v": F.sum("v")})
        q = sink(agg, out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    run([(i % 3, 1) for i in range(30)])
    time.sleep(2.5)                      # the wall clock passes every window of the first batch
    run([(9, 1)])
    rows = spark.read.parquet(out).where("key < 9").collect()
    # every record lands in size / slide = 2 windows
    assert sum(r.v for r in rows) == 60


def test_batchwise_counts_match_the_stateful_fold_and_survive_a_repeated_batch(spark):
    docs = from_elements(spark, WINDOW_WORDS).withColumnRenamed("seq", "doc_id")
    out, state = scratch_path(spark, "t-cb"), scratch_path(spark, "t-cb-state")
    fn = count_window_batches("word", ["doc_id", "pos"], 6, 1, state, lambda d, i: d.write.mode("overwrite").parquet(
        f"{out}/batch_id={i}"))

    def twice(batch, batch_id):
        fn(batch, batch_id)
        fn(batch, batch_id)

    replay(docs, F.col("doc_id"), 4, lambda s: tokenize_words(s).writeStream.foreachBatch(twice), "t-cb")
    by = {}
    for r in sorted(spark.read.parquet(out).collect(), key=lambda r: (r.doc_id, r.pos)):
        by.setdefault(r.word, []).append(r.n)
    assert by["bytedance"] == [1, 2, 3, 4, 5] and by["hello"] == [1, 2, 3]
    assert sum(map(len, by.values())) == 24


def test_stream_tuple_text_and_console(spark, capfd):
    df = from_tuples(spark, [(1, "a"), (2, None), (3, "c")], "id long, w string")
    out = scratch_path(spark, "t-text")
    replay(df, F.col("id"), 3, lambda s: stream_tuple_text(s, out, ["w", "id"]), "t-text")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(a,1)", "(c,3)", "(null,2)"]
    replay(df, F.col("id"), 1, lambda s: stream_show(s), "t-console")


def test_delta_function_of_old_and_new(spark):
    values = [10, 14, 9, 30, 29, 5, 16]
    df = from_tuples(spark, [(1, i, v) for i, v in enumerate(values)], "k int, t long, v long") \
        .withColumn("ts", F.timestamp_micros("t"))
    got = delta_trigger_fires_sequential(df, ["k"], "ts", "t", "v", 10, n_slices=3, delta=lambda old, new: abs(new - old))
    assert sorted(r.t for r in got.collect()) == [3, 5, 6]


@pytest.mark.parametrize("lines", [None, ("line", "o")])
def test_large_slices_are_several_files_and_one_batch(spark, monkeypatch, lines):
    """All cores write and read a slice; batches stay the slices, in order."""
    from tidepool.streaming import replay as R

    monkeypatch.setattr(R, "FILE_BYTES", 1)
    df = spark.createDataFrame([(o, str(o)) for o in [*range(40), 90, *range(150, 200)]], "o long, line string")   # one slice is empty, one has a row
    seen = {}

    def write(batch, batch_id):
        rows = batch.collect()
        seen[batch_id] = [r.line for r in sorted(rows, key=lambda r: (r.file, r.line_start))] if lines else sorted((r.line for r in rows), key=int)
        seen["files", batch_id] = len({r.file for r in rows})

    R.replay(df, F.col("o"), 5, lambda stream: (stream if lines else stream.withColumn("file", F.input_file_name())).writeStream.foreachBatch(write), "files", lines=lines)
    got = [seen.get(i, []) for i in range(5)]
    assert [len(g) for g in got if g] == [len(w) for w in slices_of(df, 5) if len(w)]
    assert [int(x) for g in got for x in g] == [r.o for r in df.orderBy("o").collect()]
    assert max(n for k, n in seen.items() if isinstance(k, tuple)) > 1


def slices_of(df, n):
    lo, hi = df.selectExpr("min(o)", "max(o)").first()
    at = [min(int((r.o - lo) / ((hi - lo) / n)), n - 1) for r in df.collect()]
    return [[x for x in at if x == k] for k in range(n)]
