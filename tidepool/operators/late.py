"""Watermarks per record, and the rows that sessions drop as late.

Records arrive in a given order.  After each one the source's watermark is the
latest event time so far less a lag; it never falls.  A record opens the window
``[t, t + gap)``, merged with the sessions of its key that it touches and that
the watermark has not closed.  It is late, and dropped, iff the merged window
lies behind the watermark that it meets (``end - 1 <= watermark``); a dropped row
extends nothing, and a closed session is gone.

* The watermark is a maximum over all earlier records, whatever their key:
  maxima within blocks of the arrival order and over the blocks before.
* A row whose own window is still open is never late.  Any other is saved only
  by an open session of its key, so a key's arrivals fall apart where none can
  be open (latest time of the key plus gap behind the watermark), and only
  those parts that hold a doubtful row are folded -- in arrival order, over
  sorted partitions and batch by batch, so that a part of any length needs no
  more memory than its open sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .prefix import BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, null_safe_join, range_block
from .rolling import rolling_sums


def with_watermark_column(df: DataFrame, order: Sequence[str], t: str, lag: int, name: str = "watermark",
                          block_on: str | Column | None = None, n_blocks: int | None = None) -> DataFrame:
    """``df`` with the watermark that each record meets: the largest ``t`` of all
    records before it in ``order``, less ``lag`` (NULL before the first time)."""
    at = F.col(order[0] if block_on is None else block_on) if not isinstance(block_on, Column) else block_on
    blk = range_block(df, at, n_blocks or default_blocks(df), MIN_ROWS_PER_BLOCK if n_blocks is None else 1)
    rows = df.withColumn(BLOCK, blk)
    w = Window.partitionBy(BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_run", F.max(t).over(w))
    tops = rows.groupBy(BLOCK).agg(F.max(t).alias("_top"))      # one row per block
    before = F.max("_top").over(Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(F.broadcast(tops.select(BLOCK, before.alias("_before"))), BLOCK)
    return rows.select(*df.columns, (F.greatest("_run", "_before") - lag).alias(name))


def _fold(keys: list[str], gap: int):
    def run(batches):
        part, sessions = None, []
        for pdf in batches:
            late = np.zeros(len(pdf), bool)
            parts = list(zip(*[pdf[k].astype(object).where(pdf[k].notna(), None) for k in keys], pdf["_part"], strict=True))
            for i, (here, t, mark, open_) in enumerate(zip(parts, pdf["_t"], pdf["_mark"], pdf["_some"], strict=True)):
                if here != part:
                    part, sessions = here, []
                if open_:
                    sessions = [s for s in sessions if s[1] - 1 > mark]
                touched = [s for s in sessions if s[0] <= t + gap and s[1] >= t]
                start, end = min([t, *[s[0] for s in touched]]), max([t + gap, *[s[1] for s in touched]])
                late[i] = open_ and end - 1 <= mark
                if not late[i]:
                    sessions = [s for s in sessions if s not in touched] + [(start, end)]
            out = pdf.drop(columns=["_part", "_t", "_mark", "_some"])
            out["late"] = late
            yield out

    return run


def late_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], t: str, gap: int, lag: int,
              block_on: str | Column | None = None, n_blocks: int | None = None) -> DataFrame:
    """``df`` with ``watermark`` and ``late``.

    ``t`` is an integer event time (one unit is the resolution of time), ``order``
    the total order of arrival.  Rows with a NULL time are not late and touch no
    session.
    """
    keys, order = list(keys), list(order)
    rows = with_watermark_column(df, order, t, lag, "watermark", block_on, n_blocks)
    mark = F.col("watermark")
    rows = rolling_sums(rows, keys, order, {"_latest": ("max", F.col(t))}, block_on, n_blocks, df, exclusive=True)
    closed = F.col("_latest").isNull() | F.coalesce(F.col("_latest") + gap - 1 <= mark, F.lit(False))
    own = F.coalesce(F.col(t) + gap - 1 <= mark, F.lit(False))
    rows = rows.withColumn("_opens", closed).withColumn("_own", own)
    rows = rolling_sums(rows, keys, order, {"_part": F.col("_opens").cast("long")}, block_on, n_blocks, df)
    rows = materialize(rows)
    doubtful = rows.where("_own AND NOT _opens").select(*keys, "_part").distinct().withColumn("_fold", F.lit(True))
    rows = null_safe_join(rows, doubtful, [*keys, "_part"], "left")
    plain = rows.where(F.col("_fold").isNull() | F.col(t).isNull()).select(*df.columns, "watermark", F.col("_own").alias("late"))
    fold = rows.where(F.col("_fold") & F.col(t).isNotNull())
    fold = fold.select(*keys, *[c for c in order if c not in keys], "_part", F.col(t).cast("long").alias("_t"),
                       F.coalesce(mark, F.lit(0)).cast("long").alias("_mark"), mark.isNotNull().alias("_some"))
    schema = T.StructType([*[fold.schema[c] for c in fold.columns if not c.startswith("_")], T.StructField("late", T.BooleanType())])
    sorted_parts = fold.repartition(*keys, "_part").sortWithinPartitions(*keys, "_part", *order)
    told = sorted_parts.mapInPandas(_fold(keys, gap), schema)
    folded = rows.where(F.col("_fold") & F.col(t).isNotNull()).select(*df.columns, "watermark")
    ids = list(dict.fromkeys([*keys, *order]))
    return plain.unionByName(null_safe_join(folded, told, ids))
