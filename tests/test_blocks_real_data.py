"""The block count must not change any result: real sf0.01 events, one
block versus many."""

from pyspark.sql import functions as F

from tidepool.operators.delta import delta_trigger_fires
from tidepool.operators.rolling import rolling_sum
from tidepool.operators.session import session_windows
from tidepool.operators.trailing import trailing_time_max
from tidepool.plans.event_jobs import TRIGGER_CENTI, telemetry
from tidepool.functions.telemetry import speed_centi

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_odometer_fires_sessions_and_trailing_max_do_not_depend_on_blocks(spark):
    tel = telemetry(spark, SF).withColumn("_sc", speed_centi(F.col("speed")))

    def odo(n):
        return rolling_sum(tel, ["car_id"], ["ts", "seq"], F.col("_sc"), "dist_c",
                           block_on=F.unix_micros("ts"), n_blocks=n)

    one, many = odo(1), odo(37)
    assert rows(one) == rows(many)

    f1 = delta_trigger_fires(one, ["car_id"], "ts", "seq", "dist_c", TRIGGER_CENTI, n_blocks=1)
    f2 = delta_trigger_fires(one, ["car_id"], "ts", "seq", "dist_c", TRIGGER_CENTI, n_blocks=23)
    assert rows(f1.select("car_id", "seq")) == rows(f2.select("car_id", "seq"))
    assert f1.count() == 2158

    s1 = session_windows(tel, ["car_id"], "ts", 600_000_000, {"n": F.count(F.lit(1))}, tiebreak=["seq"], n_blocks=1)
    s2 = session_windows(tel, ["car_id"], "ts", 600_000_000, {"n": F.count(F.lit(1))}, tiebreak=["seq"], n_blocks=41)
    assert rows(s1) == rows(s2)

    t1 = trailing_time_max(tel, ["car_id"], "ts", 7_200_000_000, "speed", ["seq"], ["seq"], n_blocks=1,
                           strategy="frame")
    t2 = trailing_time_max(tel, ["car_id"], "ts", 7_200_000_000, "speed", ["seq"], ["seq"], n_blocks=29,
                           strategy="frame")
    assert rows(t1.select("seq", "top_seq")) == rows(t2.select("seq", "top_seq"))
