"""Replay a table as a stream, slice by slice.

The source table is scanned once and written by slice (contiguous ranges of an
order value) under the shared checkpoint dir.  The slices are then appended in
order, the same number of files each, to the folder that one streaming query
reads with ``availableNow`` and as many files per micro-batch: a file stream
takes files by their time, so each slice is one micro-batch, in order.  The
driver only loops over slice numbers; every write and read is a Spark job.  A
small slice is one file; a large one is as many as the cluster writes at once.

An optional *sentinel* (one far-future row with NULL keys, derived from the
table by Spark) advances the watermark past every open window at the end,
standing in for the end-of-input flush; consumers drop NULL-key results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..session import scratch_path
from ..sources.records import text_lines


def slice_index(df: DataFrame, value: Column, n_slices: int) -> Column:
    lo, hi = df.select(F.min(value), F.max(value)).first()
    if lo is None or hi == lo:
        return F.lit(0)
    span = (float(hi) - float(lo)) / n_slices
    return F.least(F.floor((value - F.lit(lo)) / F.lit(span)), F.lit(n_slices - 1)).cast("int")


def sentinel_row(df: DataFrame, ts: str, ahead: str) -> DataFrame:
    """One row: every column NULL except ``ts`` = max(ts) + ``ahead``."""
    last = df.agg(F.max(ts).alias(ts))
    cols = [(F.col(ts) + F.expr(f"INTERVAL {ahead}")).cast(f.dataType).alias(f.name) if f.name == ts
            else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return last.select(*cols)


FILE_BYTES = 4 << 20          # of a slice's file, if the cluster has a core for each


def _files_per_slice(slices: DataFrame) -> int:
    """Files that the largest slice is written to: by the bytes of its staged files."""
    staged = slices.select("_slice", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct()
    largest = staged.groupBy("_slice").agg(F.sum("b").alias("b")).agg(F.max("b")).first()[0] or 0
    return max(1, min(-(-largest // FILE_BYTES), slices.sparkSession.sparkContext.defaultParallelism))


def replay(df: DataFrame, slice_value: Column, n_slices: int,
           build: Callable[[DataFrame], DataStreamWriter], label: str,
           sentinel: DataFrame | None = None, slice_order: list[int] | None = None,
           lines: tuple[str, str] | None = None) -> list:
    """Run ``build(stream)`` over ``df`` replayed in ``n_slices`` slices.

    With ``lines = (column, order)`` the slices are text files of that column's
    values, one line each in ``order``, and ``build`` gets ``text_lines`` of them.

    Returns the progress reports of every micro-batch.
    """
    spark = df.sparkSession
    staged, src, ckpt = (scratch_path(spark, f"{label}-{part}") for part in ("slices", "src", "ckpt"))
    df.withColumn("_slice", slice_index(df, slice_value, n_slices)).write.partitionBy("_slice").parquet(staged)
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])
    slices = spark.read.schema(schema).parquet(staged)

    n_files = _files_per_slice(slices)
    plain = spark.read.schema(df.schema) if lines is None else spark.read
    appended = 0

    def append(rows: DataFrame) -> None:
        nonlocal appended
        appended += n_files
        few = rows.coalesce(1)
        if n_files > 1:                   # text files and their lines lie in order
            few = rows.repartition(n_files, *rows.columns) if lines is None else rows.repartitionByRange(n_files, lines[1])
        if lines is not None:
            few = few.sortWithinPartitions(lines[1]).select(lines[0])
        fmt = "parquet" if lines is None else "text"
        few.write.mode("append").format(fmt).save(src)
        # parts without rows leave no file: others, without rows, make up the number
        for _ in range(appended - len(plain.format(fmt).load(src).inputFiles())):
            few.limit(0).write.mode("append").format(fmt).save(src)

    for k in (slice_order if slice_order is not None else range(n_slices)):
        append(slices.where(F.col("_slice") == k).drop("_slice"))
    if sentinel is not None:
        # The first sentinel batch raises the watermark; windows it closes
        # are evicted by the next batch, so the sentinel is sent twice.
        append(sentinel)
        append(sentinel)
    if lines is None:
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", n_files).parquet(src)
    else:
        stream = text_lines(spark, src, streaming=True, files_per_batch=n_files)
    q = build(stream).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return list(q.recentProgress)


def dropped_by_watermark(progress: list) -> int:
    """Rows the stateful operators dropped as late, summed over the replay's
    progress reports (Spark counts per aggregated row: a late record in two
    sliding windows counts twice)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))
