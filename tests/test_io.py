import pytest
from pyspark.sql import functions as F

from tidepool.session import scratch_path
from tidepool.sinks.tuple_text import parse_tuple_line, tuple_lines, write_tuple_text
from tidepool.sources.records import from_tuples, text_lines


def test_tuple_text_round_trip_and_fail_if_exists(spark):
    df = from_tuples(spark, [("spark", 3), ("stream", None)], "word string, n long").drop("seq")
    assert sorted(r.value for r in tuple_lines(df).collect()) == ["(spark,3)", "(stream,null)"]
    path = scratch_path(spark, "t-tuple")
    write_tuple_text(df.where("n IS NOT NULL"), path)
    back = text_lines(spark, path).select(*parse_tuple_line("line")).collect()
    assert [(r.word, r.n) for r in back] == [("spark", 3)]
    with pytest.raises(Exception):
        write_tuple_text(df, path)


def test_text_lines_keep_line_order(spark):
    path = scratch_path(spark, "t-lines")
    spark.range(5000).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.text(path)
    rows = text_lines(spark, path).orderBy("file", "line_start", "line_no").collect()
    assert [int(r.line) for r in rows] == list(range(5000))


def test_text_lines_stream(spark):
    path = scratch_path(spark, "t-lines-s")
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.text(path)
    out = scratch_path(spark, "t-lines-out")
    q = (text_lines(spark, path, streaming=True).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-lines-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.line for r in spark.read.parquet(out).collect()) == ["a", "b"]
