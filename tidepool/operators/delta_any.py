"""Delta trigger for a measure that may rise and fall, in any record order.

Per key, the first record sets the reference and does not fire; a later one
fires iff its ``difference`` to the reference (``new - old``), or its
``distance`` (``|new - old|``), exceeds the threshold, and is the next reference.

The fold is sequential, but cuts into blocks of the order axis:

* after its first fire in a block, the rest of the block's fires follow from
  that record alone: its successor is the first later record far enough away,
  found for all records at once by a sparse table of maxima and minima, and the
  end of the chain of successors by pointer doubling;
* which record fires first depends on the reference that enters the block, and
  only records above (or below) all earlier ones of the block can be it.  The
  references that can enter are bounded by the blocks before: their largest
  value (a rise beyond the threshold fires), or their last one (both ways).

So a block is a short list of such records with the reference that each leaves
behind.  A walk over the lists gives every block its entry reference, and the
blocks emit their fires independently.  Only heavy keys are cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, heavy_keys, mark_heavy, null_safe_join, range_block

KINDS = ("difference", "distance")
MAX_BLOCK = 250_000          # rows of the table per block: a task holds a table of log2 as many rows


def _fires(new, old, threshold, kind: str):
    """The trigger's test, as written: exact for integers, one subtraction for floats."""
    apart = new - old
    return (apart > threshold) | (-apart > threshold) if kind == "distance" else apart > threshold


def successors(d: np.ndarray, threshold, kind: str) -> np.ndarray:
    """For every record the first later one that fires against it (``len(d)``: none)."""
    n = len(d)
    tops, lows = [d], [d]
    while 2 ** len(tops) <= n:
        half = 2 ** (len(tops) - 1)
        tops.append(np.maximum(tops[-1][:-half], tops[-1][half:]))
        if kind == "distance":
            lows.append(np.minimum(lows[-1][:-half], lows[-1][half:]))
    at = np.arange(1, n + 1)
    for level in reversed(range(len(tops))):
        # skip 2**level records when none of them fires
        can = np.flatnonzero(at + 2**level <= n)
        quiet = ~_fires(tops[level][at[can]], d[can], threshold, "difference")
        if kind == "distance":
            quiet &= ~_fires(d[can], lows[level][at[can]], threshold, "difference")
        at[can[quiet]] += 2**level
    return at


def chain_ends(nxt: np.ndarray) -> np.ndarray:
    """The last record of the chain of fires that starts at each record."""
    p = np.where(nxt < len(nxt), nxt, np.arange(len(nxt)))
    while not np.array_equal(q := p[p], p):
        p = q
    return p


def _records(d: np.ndarray, sign: int) -> np.ndarray:
    """Records above (``sign`` 1) or below (-1) all before them."""
    run = np.maximum.accumulate(d) if sign > 0 else np.minimum.accumulate(d)
    return np.flatnonzero(np.concatenate([[True], d[1:] > run[:-1] if sign > 0 else d[1:] < run[:-1]]))


def _candidates(d, threshold, kind, least, most):
    """First fires for entry references in ``[least, most]``: upward, downward."""
    up = _records(d, 1)
    hit = _fires(d[up], least, threshold, "difference")
    sure = _fires(d[up], most, threshold, "difference")
    first, last = (int(hit.argmax()) if hit.any() else len(up)), (int(sure.argmax()) if sure.any() else len(up) - 1)
    up = up[first : last + 1]
    if kind == "difference":
        return up, up[:0]
    down = _records(d, -1)
    hit, sure = _fires(most, d[down], threshold, "difference"), _fires(least, d[down], threshold, "difference")
    first, last = (int(hit.argmax()) if hit.any() else len(down)), (int(sure.argmax()) if sure.any() else len(down) - 1)
    return up, down[first : last + 1]


def _sorted(pdf: pd.DataFrame, order: list[str]) -> pd.DataFrame:
    if pdf["_d"].isna().any():
        raise ValueError("delta trigger: the measure must not be NULL or NaN")
    return pdf.sort_values(order, kind="stable", na_position="first")


def _summary_fn(keys, order, threshold, kind, numpy_type):
    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _sorted(pdf, order)
        d = pdf["_d"].to_numpy(numpy_type)
        ends = chain_ends(successors(d, threshold, kind))
        if pdf["_opens"].iloc[0]:
            up = down = np.zeros(0, int)
        else:
            up, down = _candidates(d, threshold, kind, pdf["_least"].iloc[0], pdf["_most"].iloc[0])
            if kind == "difference" and len(up):          # one entry per exit
                keep = np.concatenate([d[ends[up]][1:] != d[ends[up]][:-1], [True]])
                up = up[keep]
        row = {k: pdf[k].iloc[0] for k in [*keys, BLOCK, "_opens"]}
        row |= {"_first": d[0], "_exit": d[ends[0]], "_up": d[up].tolist(), "_up_at": up.tolist(), "_up_exit": d[ends[up]].tolist(),
                "_down": d[down].tolist(), "_down_at": down.tolist(), "_down_exit": d[ends[down]].tolist()}
        return pd.DataFrame([row])

    return summarise


def _walk_fn(keys, threshold, kind, numpy_type):
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        ref, entries = None, []
        for i in range(len(pdf)):
            b = pdf.iloc[i]
            if b["_opens"]:
                ref = b["_exit"]
                entries.append(b["_first"])               # not used: the block opens its key
                continue
            entries.append(ref)
            up, down = np.asarray(b["_up"], numpy_type), np.asarray(b["_down"], numpy_type)
            above, below = _fires(up, ref, threshold, "difference"), _fires(ref, down, threshold, "difference")
            found = [(b["_up_at"][j], b["_up_exit"][j]) for j in [int(above.argmax())] if above.any()] if len(up) else []
            found += [(b["_down_at"][j], b["_down_exit"][j]) for j in [int(below.argmax())] if below.any()] if len(down) else []
            if found:
                ref = numpy_type(min(found)[1])
        out = pdf[[*keys, BLOCK]].copy()
        out["_entry"] = np.array(entries, numpy_type)
        return out

    return walk


def _emit_fn(order, threshold, kind, numpy_type, columns):
    def emit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _sorted(pdf, order)
        d = pdf["_d"].to_numpy(numpy_type)
        nxt = successors(d, threshold, kind)
        if pdf["_opens"].iloc[0]:
            j = int(nxt[0])
        else:
            far = _fires(d, numpy_type(pdf["_entry"].iloc[0]), threshold, kind)
            j = int(far.argmax()) if far.any() else len(d)
        hits = []
        while j < len(d):
            hits.append(j)
            j = int(nxt[j])
        return pdf.iloc[hits][columns]

    return emit


def change_fires(df: DataFrame, keys: Sequence[str], order: Sequence[str], measure: str, threshold: float,
                 kind: str = "difference", block_on: str | Column | None = None, n_blocks: int | None = None,
                 min_rows_per_block: int = MIN_ROWS_PER_BLOCK, block_source: DataFrame | None = None) -> DataFrame:
    """``(keys..., order..., measure)`` of the records at which the trigger fires.

    ``order`` must be total per key (NULLs first); the measure is numeric and not NULL
    (checked).  Integers compare exactly, floats by one subtraction.
    ``block_on``, ``block_source`` and ``n_blocks`` as in ``rolling_sum``: ``block_on``
    must be monotone in ``order``.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind of delta {kind!r}")
    keys, order = list(keys), list(order)
    whole = isinstance(df.schema[measure].dataType, T.IntegralType)
    d_type, numpy_type = ("long", np.int64) if whole else ("double", np.float64)
    if whole:
        threshold = math.floor(threshold)
    slim = df.select(*keys, *order, F.col(measure).cast(d_type).alias("_d"))
    at = F.col(order[0] if block_on is None else block_on) if not isinstance(block_on, Column) else block_on
    cut_all = n_blocks is not None    # an explicit block count is used as given
    heavy = None if cut_all else heavy_keys(slim, keys)[0]
    if cut_all:
        min_rows_per_block = 1
    columns = [*keys, *order, "_d"]
    slim_schema = T.StructType([slim.schema[c] for c in columns])
    emit = _emit_fn(order, threshold, kind, numpy_type, columns)
    if heavy is None and not cut_all:
        alone = slim.withColumn("_opens", F.lit(True)).withColumn("_entry", F.lit(None).cast(d_type))
        return alone.groupBy(*keys).applyInPandas(emit, slim_schema).withColumnRenamed("_d", measure)

    src = df if block_source is None else block_source
    blk = range_block(src, at, n_blocks or default_blocks(df), min_rows_per_block, MAX_BLOCK)
    # the block column may need columns of ``df`` that ``slim`` has dropped
    rows = df.select(*keys, *order, F.col(measure).cast(d_type).alias("_d"), blk.alias(BLOCK))
    if not cut_all:
        rows = mark_heavy(rows, keys, heavy).withColumn(BLOCK, F.when(F.col("_heavy"), F.col(BLOCK)).otherwise(F.lit(0).cast("long")))
    else:
        rows = rows.withColumn("_heavy", F.lit(True))

    # the references that can enter a block, from the blocks before it
    last = F.max_by("_d", F.struct(*order))
    spans = rows.where("_heavy").groupBy(*keys, BLOCK).agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"), last.alias("_last"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    low, high = F.min("_lo").over(before), F.max("_hi").over(before)
    slack = F.lit(0).cast(d_type) if whole else F.abs(high) * 1e-9 + F.abs(low) * 1e-9 + abs(threshold) * 1e-9
    limit = F.lit(threshold).cast(d_type)
    if threshold < 0:
        least, most = low, high
    elif kind == "difference":
        least, most = F.greatest(low, high - limit - slack), high
    else:
        ended = F.lag("_last").over(Window.partitionBy(*keys).orderBy(BLOCK))
        least, most = F.greatest(low, ended - limit - slack), F.least(high, ended + limit + slack)
    spans = spans.select(*keys, BLOCK, high.isNull().alias("_opens"), F.coalesce(least, F.lit(0).cast(d_type)).alias("_least"),
                         F.coalesce(most, F.lit(0).cast(d_type)).alias("_most"))

    summary = T.StructType([*[slim.schema[k] for k in keys], T.StructField(BLOCK, T.LongType()), T.StructField("_opens", T.BooleanType())])
    many = f"_first {d_type}, _exit {d_type}, _up array<{d_type}>, _up_at array<long>, _up_exit array<{d_type}>, _down array<{d_type}>, _down_at array<long>, _down_exit array<{d_type}>"
    summary = T.StructType([*summary.fields, *T.StructType.fromDDL(many).fields])
    bounded = null_safe_join(rows.where("_heavy").drop("_heavy"), spans, [*keys, BLOCK])
    blocks = bounded.groupBy(*keys, BLOCK).applyInPandas(_summary_fn(keys, order, threshold, kind, numpy_type), summary)
    entry = T.StructType([*[slim.schema[k] for k in keys], T.StructField(BLOCK, T.LongType()), T.StructField("_entry", T.LongType() if whole else T.DoubleType())])
    entries = blocks.groupBy(*keys).applyInPandas(_walk_fn(keys, threshold, kind, numpy_type), entry)
    entries = null_safe_join(spans.select(*keys, BLOCK, "_opens"), entries, [*keys, BLOCK])
    known = null_safe_join(rows, entries, [*keys, BLOCK], "left")
    known = known.select(*columns, BLOCK, F.coalesce("_opens", F.lit(True)).alias("_opens"), F.coalesce("_entry", F.lit(0).cast(d_type)).alias("_entry"))
    return known.groupBy(*keys, BLOCK).applyInPandas(emit, slim_schema).withColumnRenamed("_d", measure)
