"""Sliding count windows: per key, fire on every ``slide``-th record and
aggregate the last ``size`` records (fewer before the key has ``size``).
The ``n mod slide`` trailing records of a key never fire, not even at the
end of input.  ``slide == size`` is the tumbling case.

A count window is a sliding window on the per-key record ordinal.  The
ordinal comes from the skew-safe blocked prefix count; then

* counting (no value column): the firing record's window count is
  ``least(ordinal, size)`` -- no further shuffle;
* summing a value, ``expand`` plan: every record is copied to the
  ≤ ceil(size/slide) fires whose window holds it, and ``(key, fire)``
  groups are aggregated (partial aggregation before the exchange, each
  group holds at most ``size`` rows);
* summing a value, ``prefix`` plan: the window sum is ``S(fire) -
  S(fire - size)`` of the running sum ``S`` (same blocked pass as the
  ordinal); each firing row and each row ``size`` before a fire is sent to
  the fire's ``(key, ordinal)`` group (at most two rows) in one pass.  Exact for integral and
  decimal values; its cost does not grow with ``size / slide``.  ``auto``
  picks it for exact types when ``size / slide`` exceeds
  :data:`EXPAND_MAX_RATIO`.  Both plans give the same values (NULL for a
  window of NULLs) and the type of ``sum``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import MIN_ROWS_PER_BLOCK
from .rolling import rolling_sum, rolling_sums

ORDINAL = "seq_in_key"
EXPAND_MAX_RATIO = 8


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int,
                 value: Column | None = None, name: str = "n", block_on: str | Column | None = None,
                 n_blocks: int | None = None, block_source: DataFrame | None = None,
                 min_rows_per_block: int = MIN_ROWS_PER_BLOCK, strategy: str = "auto") -> DataFrame:
    """Rows ``(keys..., order..., seq_in_key, name)``, one per fire; ``order``
    columns and ``seq_in_key`` identify the firing record."""
    if size < 1 or slide < 1:
        raise ValueError("count window size and slide must be positive")
    keys, order = list(keys), list(order)
    src = df if value is None else df.withColumn("_val", value)
    rn = F.col(ORDINAL)
    if value is not None:
        exact = isinstance(src.schema["_val"].dataType, (T.IntegralType, T.DecimalType))
        if strategy == "auto":
            strategy = "prefix" if exact and size // slide > EXPAND_MAX_RATIO else "expand"
        if strategy == "prefix":
            if not exact:
                raise ValueError("the prefix count-window plan needs integral or decimal values")
            some = F.col("_val").isNotNull().cast("long")
            ranked = rolling_sums(src, keys, order,
                                  {ORDINAL: F.lit(1).cast("long"), "_sum": F.col("_val"), "_some": some},
                                  block_on, n_blocks, block_source, min_rows_per_block)
            sum_type = src.select(F.sum("_val").alias("s")).schema["s"].dataType
            return window_differences(ranked, keys, order, size, slide, name, sum_type)
        if strategy != "expand":
            raise ValueError(f"unknown strategy {strategy!r}")
    ranked = rolling_sum(src, keys, order, None, ORDINAL, block_on, n_blocks, block_source, min_rows_per_block)
    if value is None:
        return (ranked.where(rn % slide == 0)
                .select(*keys, *order, rn, F.least(rn, F.lit(size)).cast("long").alias(name)))

    first_fire = F.ceil(rn / F.lit(slide)).cast("long") * slide
    last_fire = rn + (size - 1)
    fires = F.when(first_fire <= last_fire, F.sequence(first_fire, last_fire, F.lit(slide).cast("long"))) \
        .otherwise(F.array().cast("array<bigint>"))
    copies = ranked.select(*keys, *order, rn, "_val", F.explode(fires).alias("_fire"))
    grouped = copies.groupBy(*keys, "_fire").agg(
        F.sum("_val").alias(name),
        F.max(rn).alias("_last"),
        F.max_by(F.struct(*order), rn).alias("_rec"),
    )
    return grouped.where(F.col("_last") == F.col("_fire")).select(
        *keys, *[F.col(f"_rec.{c}").alias(c) for c in order], F.col("_fire").alias(ORDINAL), name)


def window_differences(ranked: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int, name: str,
                       sum_type: T.DataType) -> DataFrame:
    """The ``prefix`` plan's windows from running totals: ``ranked`` has the ordinal,
    ``_sum`` (running sum of the value) and ``_some`` (running count of values)."""
    rn = F.col(ORDINAL)
    ranked = ranked.withColumn("_run", F.struct("_some", "_sum"))
    # one pass over the ranked rows: a firing row reports its running
    # sum at its own ordinal, a row `size` before a fire reports its
    # running sum at the fire's ordinal; (key, ordinal) groups hold
    # at most these two rows
    fire = F.when(rn % slide == 0, F.struct(rn.alias("_at"), F.lit(True).alias("_fire")))
    before = F.when((rn + size) % slide == 0, F.struct((rn + size).alias("_at"), F.lit(False).alias("_fire")))
    parts = ranked.select(*keys, *order, "_run", F.explode(F.filter(F.array(fire, before),
                                                               lambda x: x.isNotNull())).alias("_e"))
    is_fire = F.col("_e._fire")
    grouped = parts.groupBy(*keys, F.col("_e._at").alias(ORDINAL)).agg(
        F.max(F.when(is_fire, F.col("_run"))).alias("_run"),
        F.max(F.when(~is_fire, F.col("_run"))).alias("_run_before"),
        F.max_by(F.struct(*order), is_fire.cast("int")).alias("_rec"),
        F.max(is_fire.cast("int")).alias("_has_fire"))
    run, old = F.col("_run"), F.col("_run_before")
    total = F.when(old["_sum"].isNull(), run["_sum"]).otherwise(run["_sum"] - old["_sum"])
    seen = run["_some"] > F.coalesce(old["_some"], F.lit(0))     # a value in the window
    return grouped.where(F.col("_has_fire") == 1).select(
        *keys, *[F.col(f"_rec.{c}").alias(c) for c in order], ORDINAL,
        F.when(seen, total).cast(sum_type).alias(name))
