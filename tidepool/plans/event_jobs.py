"""Time-window, session and telemetry jobs over the ``events`` table.

Mappings (fixed by this library, mirrored in the oracle SQL):

* keyed values: key ``user_id``, event time ``ts``, value ``value``; value
  sums are exact (integer hundredths, the data carries two decimals) and
  turned into ``DOUBLE`` once at the end;
* cyclic keyed range: ``key = event_id mod 10000 + 1``, ``value = 1``,
  arrival time = ``event_id`` ms (one record per ms);
* cars: ``car_id = user_id mod 8``, ``speed = value`` km/h sampled once per
  second, ``seq = event_id``; the odometer accumulates ``speed / 3.6`` metres
  in exact 1/100 km/h·s units (``dist_c``; 50 m = 18000).

Time windows are scaled from the reference's milliseconds to seconds where
the events (spread over 30 days) would otherwise fill one record per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import SLIDING_SIZE_MS, SLIDING_SLIDE_MS, TOP_SPEED_TRIGGER_METERS
from ..functions.telemetry import centi_kmh_seconds_to_metres, speed_centi
from ..operators.count_window import count_window
from ..operators.delta import delta_trigger_fires
from ..operators.delta_any import change_fires
from ..operators.global_window import Count, Delta, Span, global_window
from ..operators.late import late_rows, with_watermark_column
from ..operators.user_functions import map_records
from ..operators.reduce import keyed_reduce, rolling_reduce, window_reduce
from ..operators.rolling import rolling_sum
from ..operators.session import session_windows
from ..operators.time_window import sliding_window_agg
from ..operators.trailing import max_by_record, trailing_max_at, trailing_time_max
from ..sources.records import keyed_range, parse_telemetry, telemetry_from_events, telemetry_lines
from ..session import materialize
from ..sources.tables import as_utc_timestamp, read_table

SECOND_US = 1_000_000
MS_US = 1_000
CAR_EVICT_SEC = 3600          # trailing span for the events mapping (sparse per car)
TRIGGER_CENTI = int(round(TOP_SPEED_TRIGGER_METERS * 360))   # 50 m in 1/100 km/h·s


def cents(c: Column) -> Column:
    """A two-decimal value as exact integer hundredths (the decimal cast
    rounds the binary double to two places first)."""
    return (c.cast("decimal(18,2)") * 100).cast("bigint")


def from_cents(c: Column) -> Column:
    """Integer hundredths as DOUBLE: one correctly rounded division, the
    same double as casting the exact decimal sum."""
    return c.cast("double") / F.lit(100.0)


def exact_sum(c: Column) -> Column:
    """Exact sum of a two-decimal value column, as DOUBLE.  Summed in
    ``bigint`` hundredths: long arithmetic in generated code, where a
    ``DECIMAL(28,2)`` buffer would run on BigDecimal."""
    return from_cents(F.sum(cents(c)))


def as_ntz(df: DataFrame) -> DataFrame:
    """Zone-free output timestamps (same wall clock; the session zone is UTC)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


def events(spark: SparkSession, sf_dir: str, columns=("event_id", "ts", "user_id", "value")) -> DataFrame:
    df = read_table(spark, sf_dir, "events", list(columns))
    return df.withColumn("ts", as_utc_timestamp("ts")) if "ts" in columns else df


def _value_windows(spark, sf_dir, size_us, slide_us, strategy="auto") -> DataFrame:
    ev = events(spark, sf_dir, ("ts", "user_id", "value"))
    out = sliding_window_agg(ev, ["user_id"], "ts", size_us, slide_us,
                             {"n": ("count", F.lit(1)), "value_sum": ("sum", cents(F.col("value")))}, strategy)
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


def sliding_time_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows 2500 s / 500 s (the reference's 2500/500 ms, scaled)."""
    return _value_windows(spark, sf_dir, SLIDING_SIZE_MS * SECOND_US, SLIDING_SLIDE_MS * SECOND_US, "expand")


def sliding_time_sum_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows 1 h / 60 s through the pane plan (ratio 60)."""
    return _value_windows(spark, sf_dir, 3600 * SECOND_US, 60 * SECOND_US, "panes")


def tumbling_time_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide == size: tumbling 1 h windows."""
    return _value_windows(spark, sf_dir, 3600 * SECOND_US, 3600 * SECOND_US)


def keyed_range_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_range(read_table(spark, sf_dir, "events", ["event_id"]), "event_id")


def src_keyed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ntz(keyed_range_source(spark, sf_dir))


def keyed_range_sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cyclic keyed records, sliding 2500 ms / 500 ms on arrival time, keyed
    sum (the grouped processing-time job, on a replayable arrival column)."""
    out = sliding_window_agg(keyed_range_source(spark, sf_dir), ["key"], "arrival",
                             SLIDING_SIZE_MS * MS_US, SLIDING_SLIDE_MS * MS_US,
                             {"value": ("sum", F.col("value"))})
    return as_ntz(out)


def keyed_range_sliding_sum_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over 100 keys, so that every window holds a key many times."""
    src = keyed_range(read_table(spark, sf_dir, "events", ["event_id"]), "event_id", n_keys=100)
    out = sliding_window_agg(src, ["key"], "arrival", SLIDING_SIZE_MS * MS_US, SLIDING_SLIDE_MS * MS_US,
                             {"value": ("sum", F.col("value"))})
    return as_ntz(out)


def session_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user, gap 1 h: count and exact value sum; the first
    record's id and type are carried (first = first arrived, lowest event_id)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type", "value"))
    out = session_windows(ev, ["user_id"], "ts", 3600 * SECOND_US,
                          {"n_events": F.count(F.lit(1)), "value_sum": exact_sum(F.col("value"))},
                          first_fields=["event_id", "event_type"], tiebreak=["event_id"], first_by=["event_id"])
    return as_ntz(out)


def keyed_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling keyed sum per user in (ts, event_id) order: one row per event."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "value"))
    out = rolling_sum(ev, ["user_id"], ["ts", "event_id"], cents(F.col("value")),
                      name="running_value", block_on=F.unix_micros("ts"))
    return as_ntz(out.withColumn("running_value", from_cents(F.col("running_value"))))


def reduce_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed reduce with a user-supplied associative combine (here ``+``),
    folded as a tree of bounded groups -- final values."""
    ev = events(spark, sf_dir, ("event_id", "user_id", "value"))
    out = keyed_reduce(ev, ["user_id"], F.col("value").cast("decimal(38,2)"), lambda a, b: a + b, "value_sum")
    return out.withColumn("value_sum", F.col("value_sum").cast("double"))


def count_window_sum_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 10 / 5 per user summing a value (the general path)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "value"))
    out = count_window(ev, ["user_id"], ["ts", "event_id"], 10, 5, cents(F.col("value")),
                       name="value_sum", block_on=F.unix_micros("ts"))
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


def sliding_time_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows 2500 s / 500 s per user with a user's combine function."""
    ev = events(spark, sf_dir, ("ts", "user_id", "value"))
    out = window_reduce(ev, ["user_id"], "ts", SLIDING_SIZE_MS * SECOND_US, SLIDING_SLIDE_MS * SECOND_US,
                        cents(F.col("value")), lambda a, b: a + b, "value_sum", fanin=64)
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


def rolling_reduce_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After every event, its type's largest value and the event that had it
    first: a user's combine of structs (``combine(earlier, later)``)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "event_type", "value"))
    best = F.struct(F.col("value").alias("top"), F.col("event_id").alias("top_id"))
    out = rolling_reduce(ev, ["event_type"], ["ts", "event_id"], best,
                         lambda a, b: F.when(b["top"] > a["top"], b).otherwise(a), "best",
                         block_on=F.unix_micros("ts"), min_rows_per_block=1_000)
    return out.select("event_id", "event_type", F.col("best.top").alias("top"), F.col("best.top_id").alias("top_id"))


def keyed_running_sum_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running sum per event type where every third event has no value,
    over 16 blocks."""
    ev = events(spark, sf_dir, ("event_id", "ts", "event_type", "value"))
    some = F.when(F.col("event_id") % 3 != 0, cents(F.col("value")))
    out = rolling_sum(ev, ["event_type"], ["ts", "event_id"], some, name="running_value",
                      block_on=F.unix_micros("ts"), n_blocks=16)
    return out.select("event_id", "event_type", from_cents(F.col("running_value")).alias("running_value"))


def trailing_time_max_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing maximum with times cut to the hour, so that many records
    of a car share one: arrival (``seq``) orders them.  Over the panes of six
    hours."""
    tel = telemetry(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    out = trailing_time_max(tel, ["car_id"], "ts", 6 * CAR_EVICT_SEC * SECOND_US, "speed", ["seq", "speed"], ["seq"])
    return out.select("car_id", "seq", "top_seq", "top_speed")


def count_window_sum_events_100_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 100 / 2 per user summing a value: large size/slide, so
    the prefix-difference plan is chosen."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "value"))
    out = count_window(ev, ["user_id"], ["ts", "event_id"], 100, 2, cents(F.col("value")),
                       name="value_sum", block_on=F.unix_micros("ts"))
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


def max_by_record_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, the whole event with the largest value (earliest on ties)."""
    ev = events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type", "value"))
    return as_ntz(max_by_record(ev, ["user_id"], "value", ["event_id", "ts", "event_type", "value"], "ts",
                                ["event_id"]))


def _hot_users(ev: DataFrame) -> DataFrame:
    """Events of users, with a third of all events moved to one user (-1)."""
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


def session_window_sum_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions (gap 10 min) where one user holds a third of all events: that
    one is cut into blocks, the others take the built-in window."""
    ev = _hot_users(events(spark, sf_dir, ("event_id", "ts", "user_id", "event_type", "value")))
    out = session_windows(ev, ["user_id"], "ts", 600 * SECOND_US,
                          {"n_events": F.count(F.lit(1)), "value_sum": exact_sum(F.col("value"))},
                          first_fields=["event_id", "event_type"], tiebreak=["event_id"], first_by=["event_id"],
                          min_rows_per_block=500)
    return as_ntz(out)


def count_window_sum_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window 100 / 2 summing a value, a third of all events with one user."""
    ev = _hot_users(events(spark, sf_dir))
    out = count_window(ev, ["user_id"], ["ts", "event_id"], 100, 2, cents(F.col("value")),
                       name="value_sum", block_on=F.unix_micros("ts"))
    return as_ntz(out.withColumn("value_sum", from_cents(F.col("value_sum"))))


# cars ----------------------------------------------------------------------

def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))


def parse_telemetry_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = telemetry_lines(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))
    return as_ntz(parse_telemetry(lines))


def parse_telemetry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Car lines written as text files and read back line by line (the
    job's file input), then parsed: ``seq`` travels as a leading field."""
    from ..session import scratch_path
    from ..sources.records import text_lines

    path = scratch_path(spark, "telemetry-lines")
    lines = telemetry_lines(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))
    # one record per line: "seq\t(car,speed,distance,ms)"
    lines.select(F.concat_ws("\t", F.col("seq").cast("string"), "line").alias("value")).write.text(path)
    read = text_lines(spark, path).select(
        F.split("line", "\t").getItem(0).cast("bigint").alias("seq"),
        F.split("line", "\t").getItem(1).alias("line"))
    return as_ntz(parse_telemetry(read))


def with_odometer(tel: DataFrame) -> DataFrame:
    out = rolling_sum(tel.withColumn("_sc", speed_centi(F.col("speed"))), ["car_id"], ["ts", "seq"],
                      F.col("_sc"), name="dist_c", block_on=F.unix_micros("ts"))
    return out.drop("_sc").withColumn("distance", centi_kmh_seconds_to_metres(F.col("dist_c")))


def odometer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ntz(with_odometer(telemetry(spark, sf_dir)))


def _fires(odo: DataFrame, tel: DataFrame, full_rows: bool = True) -> DataFrame:
    return delta_trigger_fires(odo, ["car_id"], "ts", "seq", "dist_c", TRIGGER_CENTI, block_source=tel,
                               full_rows=full_rows)


def delta_trigger_fires_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    tel = telemetry(spark, sf_dir)
    return as_ntz(_fires(materialize(with_odometer(tel)), tel))


def delta_trigger_fires_sequential_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fires through the general sequential fold (stateful stream
    over a time-sliced replay), joined back to the odometer rows."""
    from ..operators.delta import delta_trigger_fires_sequential

    odo = materialize(with_odometer(telemetry(spark, sf_dir)))
    fires = delta_trigger_fires_sequential(odo, ["car_id"], "ts", "seq", "dist_c", TRIGGER_CENTI)
    return as_ntz(odo.join(fires.select("car_id", "seq"), ["car_id", "seq"], "left_semi"))


def delta_trigger_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per car, the records whose speed has changed by more than 25 km/h,
    either way, since the last such record: a ``delta(old, new)`` that is no
    difference of a rising measure."""
    tel = telemetry(spark, sf_dir).withColumn("speed_c", speed_centi(F.col("speed")))
    fires = change_fires(tel, ["car_id"], ["ts", "seq"], "speed_c", 2500, "distance", block_on=F.unix_micros("ts"))
    return as_ntz(fires.select("car_id", "seq", "ts", "speed_c"))


def delta_trigger_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type (five keys, so each is cut into blocks), the events whose
    value has risen by more than 5 since the last such event, in either order
    of sign: a difference of a measure that also falls."""
    ev = events(spark, sf_dir, ("event_id", "ts", "event_type", "value")).withColumn("cents", cents(F.col("value")))
    fires = change_fires(ev, ["event_type"], ["ts", "event_id"], "cents", 500, "difference", block_on=F.unix_micros("ts"))
    return as_ntz(fires)


TOP_FIELDS = ["seq", "speed", "distance", "ts"]


def _trailing(odo: DataFrame, tel: DataFrame, strategy: str = "auto") -> DataFrame:
    return trailing_time_max(odo, ["car_id"], "ts", CAR_EVICT_SEC * SECOND_US, "speed", TOP_FIELDS, ["seq"],
                             block_source=tel, strategy=strategy)


def trailing_time_max_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every car record with the fastest record of its trailing hour."""
    tel = telemetry(spark, sf_dir)
    return as_ntz(_trailing(materialize(with_odometer(tel)), tel))


def trailing_time_max_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing maximum with the odometer, through the linear pane plan by name."""
    tel = telemetry(spark, sf_dir)
    return as_ntz(_trailing(materialize(with_odometer(tel)), tel, "panes"))


def trailing_day_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every car record with the fastest one of its trailing day (dense spans)."""
    tel = telemetry(spark, sf_dir)
    out = trailing_time_max(tel, ["car_id"], "ts", 24 * CAR_EVICT_SEC * SECOND_US, "speed", ["seq", "speed"], ["seq"])
    return out.select("car_id", "seq", "top_seq", "top_speed")


def top_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per car, every time it has moved more than 50 m since the last report,
    the fastest record of the trailing span (earliest on ties)."""
    tel = telemetry(spark, sf_dir)
    # read by the fold's stages, the fire join and the span join: computed once
    odo = materialize(with_odometer(tel))
    fires = _fires(odo, tel, full_rows=False)
    tops = trailing_max_at(fires, odo, ["car_id"], "ts", "seq", CAR_EVICT_SEC * SECOND_US, "speed", TOP_FIELDS,
                           full_rows=False)
    return as_ntz(tops.select("car_id", F.col("seq").alias("fire_seq"),
                              *[F.col("top_" + c) for c in TOP_FIELDS]))


# global windows: any trigger, any evictor ----------------------------------

ARRIVAL_DELAY_SEC = 5400
HOT_CAR_BLOCKS = 16


def arriving(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Records in another order of arrival than of time: ``arrived``
    (microseconds) is up to 90 minutes after ``ts``."""
    delay = (F.col(seq) * 7919 % ARRIVAL_DELAY_SEC) * SECOND_US
    return rows.withColumn("arrived", F.unix_micros("ts") + delay)


def _fastest() -> tuple[str, Column, Column]:
    return "max_by", F.struct("seq", "speed", "distance", "ts"), F.struct(F.col("speed"), -F.col("seq_in_key"))


def top_speed_disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-speed report on records that arrive out of order: fires when a
    record's odometer is more than 50 m beyond the last report's, content from
    the last hour before the latest time seen, the earliest arrived on ties."""
    odo = arriving(materialize(with_odometer(telemetry(spark, sf_dir))))
    out = global_window(odo, ["car_id"], ["arrived", "seq"], Delta("dist_c", TRIGGER_CENTI), Span("ts", CAR_EVICT_SEC * SECOND_US),
                        {"_top": _fastest(), "n_records": ("count", F.lit(1))}, n_blocks=HOT_CAR_BLOCKS)
    return as_ntz(out.select("car_id", F.col("seq").alias("fire_seq"), "n_records", *[F.col(f"_top.{c}").alias(f"top_{c}") for c in TOP_FIELDS]))


def count_trigger_time_evictor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 25th arrival of a car reports the records of the last six hours
    before the latest time seen: how many, their summed speed, the fastest."""
    tel = arriving(telemetry(spark, sf_dir)).withColumn("distance", F.lit(0.0))
    out = global_window(tel, ["car_id"], ["arrived", "seq"], Count(25), Span("ts", 6 * CAR_EVICT_SEC * SECOND_US),
                        {"n_records": ("count", F.lit(1)), "speed_sum": ("sum", cents(F.col("speed"))), "_top": _fastest()})
    return out.select("car_id", F.col("seq").alias("fire_seq"), "seq_in_key", "n_records", from_cents(F.col("speed_sum")).alias("speed_sum"), F.col("_top.seq").alias("top_seq"))


def delta_trigger_count_evictor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50 m a car reports its last 20 records: how many, their summed speed."""
    odo = materialize(with_odometer(telemetry(spark, sf_dir)))
    out = global_window(odo, ["car_id"], ["ts", "seq"], Delta("dist_c", TRIGGER_CENTI), Count(20),
                        {"n_records": F.count(F.lit(1)), "speed_sum": exact_sum(F.col("speed"))}, block_on=F.unix_micros("ts"))
    return out.select("car_id", F.col("seq").alias("fire_seq"), "seq_in_key", "n_records", "speed_sum")


LATE_LAG_MS = 1_200_000
LATE_GAP_MS = 1_800_000


def _late(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    ev = arriving(events(spark, sf_dir, ("event_id", "ts", key)), "event_id").withColumn("t_ms", F.unix_millis("ts"))
    out = late_rows(ev, [key], ["arrived", "event_id"], "t_ms", LATE_GAP_MS, LATE_LAG_MS)
    return out.select("event_id", key, "t_ms", "watermark", "late")


def late_rows_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, in an order of arrival other than its time, with the
    watermark that it meets (latest time before it less 20 min) and whether
    sessions per user (gap 30 min) drop it as late."""
    return _late(spark, sf_dir, "user_id")


def late_rows_exact_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per event type: five keys whose sessions stay open for long."""
    return _late(spark, sf_dir, "event_type")


def ascending_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that break ascending order of time: ``ts`` below the latest of the
    records that arrived before."""
    tel = arriving(telemetry(spark, sf_dir)).withColumn("t_us", F.unix_micros("ts"))
    marked = with_watermark_column(tel, ["arrived", "seq"], "t_us", 0, "latest_us")
    return marked.where(F.col("t_us") < F.col("latest_us")).select("seq", "car_id", "t_us", "latest_us")


def map_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The car-line parser as a user's Python map."""
    lines = telemetry_lines(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"]))

    def parse(pdf):
        f = pdf["line"].str.slice(1, -1).str.split(",", expand=True)
        return pdf[["seq"]].assign(car_id=f[0].astype("int32"), speed=f[1].astype("int32"), distance=f[2].astype("float64"), ts_ms=f[3].astype("int64"))

    return map_records(lines, parse, "seq long, car_id int, speed int, distance double, ts_ms long")
