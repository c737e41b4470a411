"""Exact per-record counts on a stream, batch by batch (``foreachBatch``).

Within a micro-batch the ordinal of a record in its key is the running count
of the batch operators, so a frequent key is spread over many tasks; the
counts up to the batch are carried (:mod:`.carried`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rolling import rolling_sums
from .carried import NEW, Sink, _blocks, _with_carried, carried

ORDINAL = "seq_in_key"


def count_window_batches(key: str, order: Sequence[str], size: int | None, slide: int, state: str, sink: Sink,
                         name: str = "n", block_on: str | Column | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: sliding count windows of ``size`` (None:
    all records so far) that fire on every ``slide``-th record of a key.
    ``sink(fires, batch_id)`` writes ``(key, order..., seq_in_key, name)``
    rows and must replace what an earlier try of the batch wrote; ``state`` is
    a folder for the counts.  ``order`` is the order within a batch; batches
    follow each other."""
    order = list(order)
    # a carried row has no order value; the plain column keeps the blocks' tests small
    at = F.col(order[0]) if block_on is None else _blocks(block_on)

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        rows = rows.select(key, *order).withColumn("_m", F.lit(1).cast("long"))
        if before is not None:        # a key's count so far is its first row
            none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
            kept = F.col(key)
            if not rows.schema[key].nullable and isinstance(rows.schema[key].dataType, T.StringType):
                kept = F.coalesce(kept, F.lit(""))     # the file does not tell it; plain keys sort faster
            before = before.select(kept.alias(key), *none, F.col("_n").alias("_m"))
        src = _with_carried(rows, before)
        ranked = rolling_sums(src, [key], [NEW, *order], {ORDINAL: F.col("_m")}, at)
        rn = F.col(ORDINAL)
        n = rn if size is None else F.least(rn, F.lit(size))
        fires = ranked.where((F.col(NEW) == 1) & (rn % slide == 0)).select(key, *order, rn, n.cast("long").alias(name))
        return fires, src.groupBy(key).agg(F.sum("_m").alias("_n"))

    return carried(step, state, sink)
