"""Guards for the scale design, read from the physical plans."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidepool.operators.trailing import trailing_time_max

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_windows_of_light_keys_shuffle_once(spark):
    p = plan(spark, "word_count_rolling")
    assert re.search(r"windowspecdefinition\(word#\d+, doc_id#", p) and "_blk" not in p


def test_trailing_query_partitions_by_pane(spark):
    p = plan(spark, "trailing_time_max")
    assert re.search(r"windowspecdefinition\(car_id#\d+L?, _p#\d+L, ", p)


def test_trailing_frame_partitions_by_block(spark):
    df = spark.range(100).select(F.lit(1).alias("car_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("v"))
    out = trailing_time_max(df, ["car_id"], "ts", 10**7, "v", ["v"], n_blocks=4, strategy="frame")
    p = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"windowspecdefinition\(car_id#\d+, _blk#\d+L, _t#\d+L ASC NULLS FIRST, "
                     r"specifiedwindowframe\(RangeFrame", p)


def test_scans_read_only_needed_columns(spark):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(spark, "word_count")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan(spark, "sliding_time_sum")


def test_keyed_totals_pre_aggregate(spark):
    p = plan(spark, "word_count")
    assert "partial_count" in p
