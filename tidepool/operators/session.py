"""Event-time session windows per key.

A session ends when the next record of the key is *more than* ``gap``
later; a difference equal to ``gap`` stays in the session.  A session spans
``[first_ts, last_ts + gap)``.  Fields other than the aggregates are taken
from the session's first record (lowest ``(ts, tiebreak)``).

Plan (gaps-and-islands, cut into time blocks so no task ever holds a whole
key; one pass over the rows):

1. per ``(key, block)`` window: a record *inside* the block starts a session
   iff its gap to the previous record exceeds ``gap``; the running max of
   those start times is the record's session start, unknown (NULL) until
   the block's first inner start;
2. per ``(key, block)`` summary of the windowed rows: first and last time,
   last inner start (Catalyst feeds it from a column-pruned copy of the
   rows, a narrow second scan);
3. per key over block summaries (≤ n_blocks rows per key): does the block's
   first record start a session (gap to the previous block's last time),
   and which session is open when the block begins (carried forward);
4. the summary is joined back on ``(key, block)`` -- the rows keep their
   partitioning, only the small side moves -- and the rows are grouped by
   ``(key, session_start)`` with partial aggregation.

That is the plan of heavy keys (``prefix.heavy_keys``).  All others take Spark's
own ``session_window``, which merges a key's sessions in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import (BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, heavy_keys, mark_heavy, partition_keys,
                     range_block)


def session_windows(df: DataFrame, keys: Sequence[str], ts: str, gap_us: int,
                    aggs: Mapping[str, Column], first_fields: Sequence[str] = (),
                    tiebreak: Sequence[str] = (), n_blocks: int | None = None,
                    min_rows_per_block: int = MIN_ROWS_PER_BLOCK,
                    block_source: DataFrame | None = None, first_by: Sequence[str] = ()) -> DataFrame:
    """``(keys..., session_start, session_end, first_<field>..., <aggs>)``.

    ``first_fields`` are of the session's lowest record by ``first_by`` (its
    order of arrival); without it, by ``ts`` and ``tiebreak``.
    ``block_source`` (default ``df``) supplies the time range for the blocks.
    An explicit ``n_blocks`` cuts every key.
    """
    keys, first_by = list(keys), list(first_by)
    if n_blocks is None:
        heavy, others = heavy_keys(df, keys)
        if heavy is None:
            return _whole_keys(df, keys, ts, gap_us, aggs, first_fields, tiebreak, first_by)
        if others:
            marked = mark_heavy(df, keys, heavy)
            light = _whole_keys(marked.where(~F.col("_heavy")), keys, ts, gap_us, aggs, first_fields, tiebreak, first_by)
            cut = _cut_keys(marked.where("_heavy").drop("_heavy"), keys, ts, gap_us, aggs, first_fields, tiebreak, None,
                            min_rows_per_block, block_source, first_by)
            return light.unionByName(cut)
    return _cut_keys(df, keys, ts, gap_us, aggs, first_fields, tiebreak, n_blocks, min_rows_per_block, block_source,
                     first_by)


def _whole_keys(df, keys, ts, gap_us, aggs, first_fields, tiebreak, first_by) -> DataFrame:
    """Sessions of keys that a task can hold, by the built-in window."""
    at = F.col(ts).cast("timestamp")
    first_key = F.struct(*[F.col(c) for c in (first_by or [ts, *tiebreak])])
    out = df.groupBy(*keys, F.session_window(at, f"{gap_us} microseconds").alias("_w")).agg(
        *([F.min_by(F.struct(*first_fields), first_key).alias("_first")] if first_fields else []),
        *[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"),
                      *[F.col(f"_first.{c}").alias(f"first_{c}") for c in first_fields], *aggs.keys())


def _cut_keys(df, keys, ts, gap_us, aggs, first_fields, tiebreak, n_blocks, min_rows_per_block, block_source,
              first_by) -> DataFrame:
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    base = df.where(F.col(ts).isNotNull()).withColumn("_t", t)
    if n_blocks is not None:          # an explicit block count is used as given
        min_rows_per_block = 1
    n_blocks = n_blocks or default_blocks(df)
    src = base if block_source is None else block_source.select(
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"))
    base = base.withColumn(BLOCK, range_block(src, F.col("_t"), n_blocks, min_rows_per_block))
    base, pk, _ = partition_keys(base, keys)

    order = [F.col("_t"), *[F.col(c) for c in tiebreak]]
    w_in = Window.partitionBy(*pk, BLOCK).orderBy(*order)
    prev_t = F.lag("_t").over(w_in)
    rows = base.withColumn("_inner", F.when(prev_t.isNotNull() & ((F.col("_t") - prev_t) > F.lit(gap_us)),
                                            F.col("_t")))
    rows = rows.withColumn("_run", F.max("_inner").over(w_in.rowsBetween(Window.unboundedPreceding,
                                                                           Window.currentRow)))

    blocks = rows.groupBy(*pk, BLOCK).agg(F.min("_t").alias("_bmin"), F.max("_t").alias("_bmax"),
                                         F.max("_inner").alias("_last_inner"))
    w_b = Window.partitionBy(*pk).orderBy(BLOCK)
    prev_max = F.lag("_bmax").over(w_b)
    blocks = blocks.withColumn("_first_starts", prev_max.isNull() | ((F.col("_bmin") - prev_max) > F.lit(gap_us)))
    blocks = blocks.withColumn(
        "_block_last", F.coalesce(F.col("_last_inner"), F.when(F.col("_first_starts"), F.col("_bmin"))))
    carried = F.last("_block_last", ignorenulls=True).over(w_b.rowsBetween(Window.unboundedPreceding, -1))
    entry = blocks.select(*pk, BLOCK, F.when(F.col("_first_starts"), F.col("_bmin")).otherwise(carried)
                          .alias("_entry"))

    rows = rows.join(entry, [*pk, BLOCK]).withColumn("_sess", F.coalesce(F.col("_run"), F.col("_entry")))

    first_key = F.struct(*[F.col(c) for c in (first_by or ["_t", *tiebreak])])
    out = rows.groupBy(*keys, "_sess").agg(
        F.max("_t").alias("_last_t"),
        *([F.min_by(F.struct(*first_fields), first_key).alias("_first")] if first_fields else []),
        *[c.alias(n) for n, c in aggs.items()],
    )
    return out.select(
        *keys,
        F.timestamp_micros(F.col("_sess")).alias("session_start"),
        F.timestamp_micros(F.col("_last_t") + F.lit(gap_us)).alias("session_end"),
        *[F.col(f"_first.{c}").alias(f"first_{c}") for c in first_fields],
        *aggs.keys(),
    )
