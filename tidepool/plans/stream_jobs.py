"""Streaming forms of the jobs: each replays a table slice by slice through
a Structured Streaming query, writes to a Parquet sink under the shared
folder, and returns the sink read back (comparable with the batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import (COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE, SLIDING_SIZE_MS, SLIDING_SLIDE_MS, WINDOW_WORDS_SIZE,
                               WINDOW_WORDS_SLIDE)
from ..functions.telemetry import centi_kmh_seconds_to_metres, speed_centi
from ..operators.tokenize import tokenize_words
from ..session import scratch_path
from ..sinks.tuple_text import parse_tuple_line, tuple_lines
from ..streaming.carried import (count_value_batches, merge_panes, pane_reduce_batches, rolling_reduce_batches,
                                 top_speed_batches)
from ..streaming.counts import count_window_batches
from ..streaming.replay import replay, sentinel_row
from ..streaming.windows import stream_session_agg, stream_sliding_agg
from ..sources.records import numbered_lines, parse_telemetry, telemetry_from_events, telemetry_lines
from ..sources.tables import read_table
from .event_jobs import CAR_EVICT_SEC, SECOND_US, TRIGGER_CENTI, as_ntz, cents, events, from_cents

N_SLICES = 5


def _parquet_sink(df: DataFrame, path: str):
    return df.writeStream.format("parquet").option("path", path).outputMode("append")


def stream_session_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions (gap 1 h) per user on a replayed event stream."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type", "value"))
    sink = scratch_path(spark, "session-out")

    def build(stream):
        return _parquet_sink(stream_session_agg(
            stream, ["user_id"], "ts", "1 hour", "1 hour",
            {"_first": F.min_by(F.struct("event_id", "event_type"), "event_id"),
             "n_events": F.count(F.lit(1)),
             "value_sum": F.sum(cents(F.col("value")))}), sink)

    replay(ev, F.unix_micros("ts"), N_SLICES, build, "session", sentinel_row(ev, "ts", "30 days"))
    out = spark.read.parquet(sink)
    return as_ntz(out.select("user_id", "session_start", "session_end",
                             F.col("_first.event_id").alias("first_event_id"),
                             F.col("_first.event_type").alias("first_event_type"),
                             "n_events", from_cents(F.col("value_sum")).alias("value_sum")))


def stream_sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time sliding windows 2500 s / 500 s per user on a replayed stream."""
    ev = events(spark, sf_dir, ("ts", "user_id", "value"))
    sink = scratch_path(spark, "sliding-out")

    def build(stream):
        return _parquet_sink(stream_sliding_agg(
            stream, ["user_id"], "ts", "2500 seconds", "500 seconds", "10 minutes",
            {"n": F.count(F.lit(1)), "value_sum": F.sum(cents(F.col("value")))}), sink)

    replay(ev, F.unix_micros("ts"), N_SLICES, build, "sliding", sentinel_row(ev, "ts", "30 days"))
    out = spark.read.parquet(sink)
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling 1 h counts per event type where the second quarter of the
    events arrives last: its windows are behind the watermark and dropped
    (no allowed lateness, no side output)."""
    ev = events(spark, sf_dir, ("ts", "event_type"))
    sink = scratch_path(spark, "late-out")

    def build(stream):
        return _parquet_sink(stream_sliding_agg(
            stream, ["event_type"], "ts", "1 hour", "1 hour", "1 hour", {"n": F.count(F.lit(1))}), sink)

    replay(ev, F.unix_micros("ts"), 4, build, "late", sentinel_row(ev, "ts", "30 days"), slice_order=[0, 2, 3, 1])
    return as_ntz(spark.read.parquet(sink))


def _doc_stream_tokens(stream: DataFrame) -> DataFrame:
    return tokenize_words(stream)


def _replay_counts(spark: SparkSession, sf_dir: str, size: int | None, slide: int, write) -> None:
    """Count windows per word over the documents replayed in ``doc_id`` order."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    batches = count_window_batches("word", ["doc_id", "pos"], size, slide, scratch_path(spark, "counts"), write)
    replay(docs, F.col("doc_id"), N_SLICES,
           lambda stream: _doc_stream_tokens(stream).writeStream.foreachBatch(batches), "countwin")


def _stream_count_window(spark: SparkSession, sf_dir: str, size: int | None, slide: int) -> DataFrame:
    sink = scratch_path(spark, "countwin-out")
    _replay_counts(spark, sf_dir, size, slide, lambda fires, batch_id: fires.write.mode("overwrite")
                   .parquet(f"{sink}/batch_id={batch_id}"))
    return spark.read.parquet(sink).drop("batch_id")


def stream_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count-window job to text files: every fire of the 10 / 5 windows
    as a ``(word,n)`` line, read back and parsed."""
    sink = scratch_path(spark, "countwin-text")
    _replay_counts(spark, sf_dir, COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE,
                   lambda fires, batch_id: tuple_lines(fires, ["word", "n"]).write.mode("overwrite")
                   .text(f"{sink}/batch_id={batch_id}"))
    return spark.read.text(sink).select(*parse_tuple_line("value"))


def stream_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 6 / 1 per word, exact per record, on a replayed document
    stream (documents arrive in doc_id order)."""
    return _stream_count_window(spark, sf_dir, WINDOW_WORDS_SIZE, WINDOW_WORDS_SLIDE)


def stream_count_window_10_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 10 / 5 per word on the replayed document stream (the
    count-window word-count job as a stream)."""
    return _stream_count_window(spark, sf_dir, COUNT_WINDOW_SIZE, COUNT_WINDOW_SLIDE)


def stream_word_count_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-token running count of its word, exact per record, on a replayed
    document stream (one count per word is kept)."""
    return _stream_count_window(spark, sf_dir, None, 1).drop("seq_in_key")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts in update mode: each micro-batch upserts the
    changed words (``foreachBatch``, idempotent per batch id); the latest
    value per word is the final count."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    sink = scratch_path(spark, "wordcount-out")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    def build(stream):
        counts = _doc_stream_tokens(stream).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        return counts.writeStream.outputMode("update").foreachBatch(write_batch)

    replay(docs, F.col("doc_id"), N_SLICES, build, "wordcount")
    ups = spark.read.parquet(sink)
    return ups.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))


def stream_json_english_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tweet job as a stream: JSON records replayed in slices, English
    filter and whitespace tokens in the stream, counts upserted per
    micro-batch; the latest value per word is the final count."""
    from ..operators.tokenize import tokenize_tweets
    from ..sources.records import json_records

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    sink = scratch_path(spark, "tweetcount-out")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    def build(stream):
        counts = tokenize_tweets(json_records(stream)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        return counts.writeStream.outputMode("update").foreachBatch(write_batch)

    replay(docs, F.col("doc_id"), N_SLICES, build, "tweetcount")
    ups = spark.read.parquet(sink)
    return ups.groupBy("word").agg(F.max_by("n", "batch_id").alias("n"))


def _batch_sink(path: str):
    return lambda out, batch_id: out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_top_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top speed per car on a replayed event stream: the batch operators on
    every micro-batch, with odometer, reference point and last hour carried."""
    tel = telemetry_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))
    sink = scratch_path(spark, "topspeed-out")
    batches = top_speed_batches("car_id", "ts", "seq", "speed_c", "speed", TRIGGER_CENTI, CAR_EVICT_SEC * SECOND_US,
                                scratch_path(spark, "topspeed-state"), _batch_sink(sink))

    def build(stream):
        # times ascend, so the watermark is the latest time
        return stream.withColumn("speed_c", speed_centi(F.col("speed"))).withWatermark("ts", "0 seconds").writeStream.foreachBatch(batches)

    replay(tel, F.unix_micros("ts"), N_SLICES, build, "topspeed")
    out = spark.read.parquet(sink)
    return as_ntz(out.select("car_id", "fire_seq", "top_seq", "top_speed",
                             centi_kmh_seconds_to_metres(F.col("top_dist_c")).alias("top_distance"), "top_ts"))


LINES_PER_BATCH = 1 << 40     # ordinals of a batch's lines stay below


def stream_top_speed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The car job from text files: lines streamed file by file, parsed and
    numbered in each micro-batch, then top speed with what it carries (whole
    km/h and milliseconds, as the lines have them)."""
    lines = telemetry_lines(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))
    sink = scratch_path(spark, "topspeedtext-out")
    top = top_speed_batches("car_id", "ts", "seq", "speed_c", "speed", TRIGGER_CENTI, CAR_EVICT_SEC * SECOND_US,
                            scratch_path(spark, "topspeedtext-state"), _batch_sink(sink), fire_ts=True)

    def parsed(batch: DataFrame, batch_id: int) -> None:
        rows = parse_telemetry(numbered_lines(batch))
        seq = F.col("line_no") + F.lit(batch_id * LINES_PER_BATCH)
        top(rows.select("car_id", "ts", seq.alias("seq"), F.col("speed").cast("double").alias("speed"),
                        (F.col("speed") * 100).cast("long").alias("speed_c")), batch_id)

    replay(lines, F.col("seq"), N_SLICES, lambda stream: stream.writeStream.foreachBatch(parsed), "topspeedtext", lines=("line", "seq"))
    out = spark.read.parquet(sink)
    return as_ntz(out.select("car_id", "fire_ts", "top_speed", "top_ts", centi_kmh_seconds_to_metres(F.col("top_dist_c")).alias("top_distance")))


def stream_count_window_sum_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 10 / 5 per user summing a value, on a replayed event stream."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "value"))
    sink = scratch_path(spark, "countsum-out")
    batches = count_value_batches("user_id", ["ts", "event_id"], cents(F.col("value")), 10, 5, scratch_path(spark, "countsum-state"),
                                  _batch_sink(sink), "value_sum", F.unix_micros("ts"))
    replay(ev, F.unix_micros("ts"), N_SLICES, lambda stream: stream.writeStream.foreachBatch(batches), "countsum")
    out = spark.read.parquet(sink)
    return as_ntz(out.select("user_id", "ts", "event_id", "seq_in_key", from_cents(F.col("value_sum")).alias("value_sum")))


def stream_rolling_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After every event of a replayed stream, its type's largest value and the
    event that had it first (a user's combine of structs)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "event_type", "value"))
    sink = scratch_path(spark, "rollreduce-out")
    best = F.struct(F.col("value").alias("top"), F.col("event_id").alias("top_id"))
    batches = rolling_reduce_batches("event_type", ["ts", "event_id"], best, lambda a, b: F.when(b["top"] > a["top"], b).otherwise(a),
                                     scratch_path(spark, "rollreduce-state"), _batch_sink(sink), "best", F.unix_micros("ts"))
    replay(ev, F.unix_micros("ts"), N_SLICES, lambda stream: stream.writeStream.foreachBatch(batches), "rollreduce")
    out = spark.read.parquet(sink)
    return out.select("event_id", "event_type", F.col("best.top").alias("top"), F.col("best.top_id").alias("top_id"))


def stream_sliding_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows 2500 s / 500 s per user with a user's combine function, from the
    pane folds of every micro-batch of a replayed stream."""
    ev = events(spark, sf_dir, ("ts", "user_id", "value"))
    sink = scratch_path(spark, "panes-out")
    size, slide = SLIDING_SIZE_MS * SECOND_US, SLIDING_SLIDE_MS * SECOND_US
    batches = pane_reduce_batches(["user_id"], "ts", slide, cents(F.col("value")), lambda a, b: a + b, _batch_sink(sink), "value_sum")
    replay(ev, F.unix_micros("ts"), N_SLICES, lambda stream: stream.writeStream.foreachBatch(batches), "panes")
    out = merge_panes(spark.read.parquet(sink).drop("batch_id"), ["user_id"], size, slide, lambda a, b: a + b, "value_sum")
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))
