"""A global rank for the rows of a table, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

_POSITION_BITS = 33          # of monotonically_increasing_id: the row within its partition


def ranked(df: DataFrame, order: Sequence[Column], rank: str, label: str) -> DataFrame:
    """``df`` with its rank (0, 1, ...) in ``order``, written once.

    The rows are dealt by ranges of ``order`` and sorted within them; a row's
    rank is its place in its range plus the sizes of the ranges before.  Only
    the sizes (one number a range) cross ranges.  Rows equal in ``order`` share a
    range, so one value that fills a table is one task: give a last column
    that tells rows apart.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    dealt = dealt.withColumn("_range", F.shiftright(place, _POSITION_BITS)).withColumn("_place", place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    kept = written(dealt, label)
    sizes = kept.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    # one row per shuffle partition, whatever the table's size
    joined = kept.join(F.broadcast(starts), "_range")
    return joined.select(*df.columns, (F.col("_start") + F.col("_place")).cast("long").alias(rank))
