"""Delta trigger on a global per-key window, and the top-speed pipeline.

Trigger semantics: per key, the first record sets the reference point and
does not fire; a later record fires iff ``measure(new) - measure(ref) >
threshold`` and then becomes the reference point.

The fold is sequential by definition, but for a *non-decreasing* measure
(an odometer) it can be cut into independent pieces:

* the next fire after a reference ``r`` is the first record with
  ``d > r + threshold`` (a binary search), and after the first fire inside
  a block the rest of that block's fires no longer depend on ``r``;
* a block's entry reference is at most its first ``d``, so only entry
  points in the block's first ``threshold`` of distance matter.

Stage A (``applyInPandas`` per ``(key, time block)``) summarises each block
as a step function *entry reference → exit reference*; consecutive steps
with the same exit are merged.  Stage B (per key, over block summaries
only) walks the blocks in order to get each block's entry reference.
Stage C (per ``(key, block)``) emits the fires.  No stage holds more than
one block of records; stage B holds a few rows per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, null_safe_join, range_block


def _sorted_measure(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["_t", "_seq"], kind="stable")
    d = pdf["_d"].to_numpy()
    if pdf["_d"].isna().any():
        raise ValueError("delta trigger: the measure must not be NULL or NaN")
    if len(d) > 1 and np.any(d[1:] < d[:-1]):
        raise ValueError("delta trigger: the measure must be non-decreasing per key in record order")
    return pdf


def _next_fire(d: np.ndarray, threshold) -> np.ndarray:
    """For every record, the index of the first record whose measure exceeds
    its own by more than ``threshold`` (``len(d)`` when none)."""
    return np.searchsorted(d, d + threshold, side="right")


def _chain_ends(nxt: np.ndarray) -> np.ndarray:
    """Last record of the fire chain starting at each record (pointer
    doubling: O(n log n) vectorised, no per-record Python loop)."""
    n = len(nxt)
    p = np.where(nxt < n, nxt, np.arange(n))
    while True:
        q = p[p]
        if np.array_equal(q, p):
            return p
        p = q


def _summary_fn(keys: list[str], threshold):
    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _sorted_measure(pdf)
        d = pdf["_d"].to_numpy()
        n = len(d)
        nxt = _next_fire(d, threshold)
        ends = _chain_ends(nxt)
        h_max = int(np.searchsorted(d, d[0] + threshold, side="right"))
        heads = np.arange(0, min(h_max, n - 1) + 1)
        heads = heads[(heads == 0) | (d[heads] > d[np.maximum(heads - 1, 0)])]
        rows = []
        for h in heads:
            lo = d[0] if h == 0 else d[h - 1] - threshold
            rows.append([lo, d[h] - threshold, d[ends[h]], False, h == 0, False])
        if h_max >= n:  # entry references that produce no fire in this block
            rows.append([d[n - 1] - threshold, d[0], d[0], True, False, True])
        # merge neighbouring steps with the same exit
        merged: list[list] = []
        for r in rows:
            if merged and not r[3] and not merged[-1][3] and merged[-1][2] == r[2]:
                merged[-1][1] = r[1]
            else:
                merged.append(r)
        # open ends are flags, as a NULL would turn integers into floats
        out = pd.DataFrame(merged, columns=["_lo", "_hi", "_exit", "_identity", "_no_lo", "_no_hi"])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        out[BLOCK] = pdf[BLOCK].iloc[0]
        out["_first_d"] = d[0]
        out["_last_d"] = d[-1]
        return out

    return summarise


def _entry_fn(keys: list[str]):
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([BLOCK, "_lo"], kind="stable")
        r = None
        prev_last = None
        out = []
        for blk, g in pdf.groupby(BLOCK, sort=True):
            first_d = g["_first_d"].iloc[0]
            if prev_last is not None and first_d < prev_last:
                raise ValueError("delta trigger: the measure must be non-decreasing per key in record order")
            prev_last = g["_last_d"].iloc[0]
            if r is None:
                r = first_d
            out.append((blk, r))
            above = g["_no_lo"].to_numpy() | (g["_lo"].to_numpy() <= r)
            below = g["_no_hi"].to_numpy() | (g["_hi"].to_numpy() > r)
            hit = np.nonzero(above & below)[0]
            if len(hit) and not bool(g["_identity"].iloc[hit[0]]):
                r = g["_exit"].iloc[hit[0]]
        res = pd.DataFrame(out, columns=[BLOCK, "_entry"])
        for k in keys:
            res[k] = pdf[k].iloc[0]
        return res

    return walk


def _fires_fn(threshold):
    def fires(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _sorted_measure(pdf)
        d = pdf["_d"].to_numpy()
        nxt = _next_fire(d, threshold)
        j = int(np.searchsorted(d, pdf["_entry"].iloc[0] + threshold, side="right"))
        idx = []
        while j < len(d):
            idx.append(j)
            j = int(nxt[j])
        return pdf.iloc[idx].drop(columns=["_entry"])

    return fires


def delta_trigger_fires(df: DataFrame, keys: Sequence[str], ts: str, seq: str, measure: str,
                        threshold: float, n_blocks: int | None = None,
                        min_rows_per_block: int = MIN_ROWS_PER_BLOCK,
                        block_source: DataFrame | None = None, full_rows: bool = True) -> DataFrame:
    """The records at which the delta trigger fires (all input columns).

    ``measure`` must be non-decreasing per key in ``(ts, seq)`` order (checked).
    Integral measures compare exactly; for floating ones the test is
    ``d_new > d_ref + threshold``.  ``block_source`` (default ``df``) supplies
    the time range for the blocks -- pass the raw input when ``df`` is
    derived, so the range scan does not recompute the derivation.  With
    ``full_rows=False`` only ``(keys..., seq, ts)`` of the fires are
    returned, without joining back to ``df``.
    """
    keys = list(keys)
    if n_blocks is not None:          # an explicit block count is used as given
        min_rows_per_block = 1
    n_blocks = n_blocks or default_blocks(df)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    slim = df.select(*keys, t.alias("_t"), F.col(seq).alias("_seq"), F.col(measure).alias("_d"))
    src = slim if block_source is None else block_source.select(t.alias("_t"))
    slim = slim.withColumn(BLOCK, range_block(src, F.col("_t"), n_blocks, min_rows_per_block))
    schema = slim.schema
    d_type = schema["_d"].dataType
    key_fields = [schema[k] for k in keys]
    if isinstance(d_type, T.IntegralType):     # the same test, without floats
        threshold = math.floor(threshold)
        slim = slim.withColumn("_d", F.col("_d").cast("long"))
        schema, d_type = slim.schema, T.LongType()

    summary_schema = T.StructType([
        T.StructField("_lo", d_type), T.StructField("_hi", d_type), T.StructField("_exit", d_type),
        *[T.StructField(f, T.BooleanType()) for f in ("_identity", "_no_lo", "_no_hi")], *key_fields, T.StructField(BLOCK, T.LongType()),
        T.StructField("_first_d", d_type), T.StructField("_last_d", d_type)])
    summaries = slim.groupBy(*keys, BLOCK).applyInPandas(_summary_fn(keys, threshold), summary_schema)

    entry_schema = T.StructType([T.StructField(BLOCK, T.LongType()), T.StructField("_entry", d_type),
                                 *key_fields])
    entries = summaries.groupBy(*keys).applyInPandas(_entry_fn(keys), entry_schema)

    with_entry = null_safe_join(slim, entries, [*keys, BLOCK])
    fire_rows = with_entry.groupBy(*keys, BLOCK).applyInPandas(_fires_fn(threshold), schema)
    if not full_rows:
        return fire_rows.select(*keys, F.col("_seq").alias(seq), F.timestamp_micros("_t").alias(ts))
    fire_ids = fire_rows.select(*keys, F.col("_seq").alias(seq))
    return null_safe_join(df, fire_ids.withColumn("_fire", F.lit(True)), [*keys, seq]).drop("_fire")


def delta_trigger_fires_sequential(df: DataFrame, keys: Sequence[str], ts: str, seq: str, measure: str,
                                   threshold: float, n_slices: int = 8,
                                   delta: Callable | None = None) -> DataFrame:
    """:func:`delta_trigger_fires` for any measure and any ``delta(old, new)``
    (a Python function of two values, default ``new - old``): the input is replayed in
    ``n_slices`` time slices through the stateful stream fold (bounded memory
    per micro-batch; each key is folded in order, slice after slice).
    Returns ``(key, seq, ts, measure)`` of the fires.  One key column."""
    from ..session import scratch_path
    from ..streaming.replay import replay
    from ..streaming.stateful import stream_delta_fires

    if len(keys) != 1:
        raise ValueError("the sequential delta fold takes one key column")
    key = keys[0]
    spark = df.sparkSession
    src = df.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t_us"), seq, measure)
    sink = scratch_path(spark, "delta-fires")

    def build(stream):
        return (stream_delta_fires(stream, key, "_t_us", seq, measure, threshold, delta)
                .writeStream.format("parquet").option("path", sink).outputMode("append"))

    replay(src, F.col("_t_us"), n_slices, build, "delta")
    return spark.read.parquet(sink).select(key, seq, F.timestamp_micros("_t_us").alias(ts), measure)
