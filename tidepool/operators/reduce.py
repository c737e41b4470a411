"""Keyed reduce with a user-supplied combine function.

``combine`` is a Column lambda ``(acc, x) -> Column`` that is associative
and commutative (``lambda a, b: a + b``, ``F.greatest``, ...).  Built-in
aggregates are faster when one exists; this is the general form.

Equal values of a key are counted first (a map-side combined aggregate) and
folded by repeated doubling, so any number of identical rows is one value.
The rest is a tree of bounded groups: on each level the values are spread
over ``ceil(largest key count / fanin)`` salts (a hash of the value), every
``(key, salt)`` group folds its at most about ``fanin`` values with
``aggregate(collect_list(...), ...)``, and the partial results become the
next level's rows.  A key with ``n`` values needs ``log_fanin(n)`` levels, each
computed once (checkpointed) and without a join.  The driver receives one
scalar (the largest key count) per level.

:func:`window_reduce` folds per key and time window, over panes;
:func:`rolling_reduce` reports the fold after every record.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .prefix import BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, partition_keys, range_block


def _fold(values: Column, combine: Callable[[Column, Column], Column], dtype) -> Column:
    # the result keeps the value type (e.g. decimal + decimal widens)
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))),
                       F.element_at(values, 1), lambda acc, x: combine(acc, x).cast(dtype))


def _times(value: Column, n: Column, combine: Callable[[Column, Column], Column], dtype) -> Column:
    """``value`` folded with itself ``n`` times: doubled once per binary digit of ``n``."""
    top = F.length(F.bin(n)) - 1
    zero = F.struct(value.alias("power"), F.lit(None).cast(dtype).alias("out"))

    def step(acc: Column, bit: Column) -> Column:
        power = acc["power"]
        with_bit = F.when(acc["out"].isNull(), power).otherwise(combine(acc["out"], power).cast(dtype))
        return F.struct(
            F.when(bit < top, combine(power, power).cast(dtype)).otherwise(power).alias("power"),
            F.when(F.getbit(n, bit) == 1, with_bit).otherwise(acc["out"]).alias("out"))

    return F.when(n == 1, value).otherwise(F.aggregate(F.sequence(F.lit(0), top), zero, step)["out"])


def keyed_reduce(df: DataFrame, keys: Sequence[str], value: Column,
                 combine: Callable[[Column, Column], Column], name: str = "value",
                 fanin: int = 4096) -> DataFrame:
    """``(keys..., name)``: ``value`` of every row of a key folded with
    ``combine`` (NULL values are skipped)."""
    if fanin < 2:
        raise ValueError("fanin must be at least 2")
    keys = list(keys)
    cur = df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull())
    dtype = cur.schema["_v"].dataType
    cur = cur.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, _times(F.col("_v"), F.col("_n"), combine, dtype).alias("_v"), F.xxhash64("_v").alias("_h"))
    level = 0
    while True:
        biggest = cur.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if biggest <= fanin:
            out = cur.groupBy(*keys).agg(F.collect_list("_v").alias("_vs"))
            return out.select(*keys, _fold(F.col("_vs"), combine, dtype).alias(name))
        level += 1
        salt = F.pmod(F.col("_h"), F.lit(-(-biggest // fanin)))
        cur = materialize(cur.groupBy(*keys, salt.alias("_salt")).agg(F.collect_list("_v").alias("_vs")).select(
            *keys, _fold(F.col("_vs"), combine, dtype).alias("_v"),
            F.xxhash64(F.col("_salt"), F.lit(level)).alias("_h")))


def window_reduce(df: DataFrame, keys: Sequence[str], ts: str, size_us: int, slide_us: int, value: Column,
                  combine: Callable[[Column, Column], Column], name: str = "value",
                  fanin: int = 4096) -> DataFrame:
    """``(keys..., window_start, window_end, name)`` per window with a value:
    :func:`keyed_reduce` per pane of ``gcd(size, slide)``, then of the panes
    of each window.  ``ts`` may be an event time or a column of arrival times;
    rows without one are in no window."""
    if size_us <= 0 or slide_us <= 0:
        raise ValueError("window size and slide must be positive")
    keys = list(keys)
    pane = math.gcd(size_us, slide_us)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, (F.floor(t / F.lit(pane)).cast("long") * pane).alias("_p"), value.alias("_value"))
    panes = keyed_reduce(rows, [*keys, "_p"], F.col("_value"), combine, "_value", fanin)
    p = F.col("_p")
    first = F.ceil((p - F.lit(size_us - pane)) / F.lit(slide_us)).cast("long") * slide_us
    last = F.floor(p / F.lit(slide_us)).cast("long") * slide_us
    starts = F.when(first <= last, F.sequence(first, last, F.lit(slide_us).cast("long")))
    copies = panes.select(*keys, "_value", F.explode(starts).alias("_s"))
    out = keyed_reduce(copies, [*keys, "_s"], F.col("_value"), combine, name, fanin)
    return out.select(*keys, F.timestamp_micros("_s").alias("window_start"),
                      F.timestamp_micros(F.col("_s") + F.lit(size_us)).alias("window_end"), name)


def _scan(df: DataFrame, col: str, w, longest: int, merge: Callable[[Column, Column], Column]) -> DataFrame:
    """Running fold of ``col`` over ``w`` by doubling: after step ``k`` a row
    holds the fold of itself and the ``2**k - 1`` rows before it.  All steps
    share one sort."""
    reach = 1
    while reach < longest:
        df = df.withColumn(col, merge(F.lag(col, reach).over(w), F.col(col)))
        reach *= 2
    return df


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                   combine: Callable[[Column, Column], Column], name: str = "value",
                   block_on: str | Column | None = None, n_blocks: int | None = None,
                   block_source: DataFrame | None = None,
                   min_rows_per_block: int = MIN_ROWS_PER_BLOCK) -> DataFrame:
    """Every record with ``value`` of its key folded up to and including
    itself, in ``order`` (which should be total).  ``combine(earlier, later)``
    need only be associative; NULL values are skipped (NULL before the first).

    A scan by doubling inside each ``(key, block)`` (written once), another
    over the block results of each key, and their join -- so a hot key is
    spread over its blocks.  ``block_on`` and ``block_source`` as in
    ``rolling_sum``.  The driver receives two scalars (the longest block and
    the most blocks of a key)."""
    keys = list(keys)
    if n_blocks is not None:          # an explicit block count is used as given
        min_rows_per_block = 1
    block_on = order[0] if block_on is None else block_on
    at = F.col(block_on) if isinstance(block_on, str) else block_on
    blk = range_block(df if block_source is None else block_source, at, n_blocks or default_blocks(df),
                      min_rows_per_block)
    base = df.withColumn("_v", value).withColumn(BLOCK, blk)
    dtype = base.schema["_v"].dataType
    base, pk, _ = partition_keys(base, keys)

    def merge(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(combine(a, b).cast(dtype))

    sizes = base.groupBy(*pk, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    longest = sizes.agg(F.max("_n")).first()[0] or 1
    w = Window.partitionBy(*pk, BLOCK).orderBy(*order)
    rows = materialize(_scan(base.withColumn("_rn", F.row_number().over(w)), "_v", w, longest, merge))
    ends = rows.groupBy(*pk, BLOCK).agg(F.max_by("_v", "_rn").alias("_end"))
    most = ends.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 1
    w_b = Window.partitionBy(*pk).orderBy(BLOCK)
    before = _scan(ends, "_end", w_b, most, merge).select(*pk, BLOCK, F.lag("_end").over(w_b).alias("_off"))
    return rows.join(before, [*pk, BLOCK]).select(*df.columns, merge(F.col("_off"), F.col("_v")).alias(name))
