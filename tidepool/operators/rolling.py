"""Keyed running aggregates: the per-record changelog of a keyed reduce/sum,
and the final totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import (BLOCK, MIN_ROWS_PER_BLOCK, blocked_running_totals, default_blocks, heavy_keys, range_block,
                     running_totals)


def keyed_totals(df: DataFrame, keys: Sequence[str], value: Column | None = None, name: str = "n") -> DataFrame:
    """Final value of a keyed sum (count when ``value`` is None): one row per
    key.  Partial aggregation runs before the exchange, so hot keys cost one
    row per map task."""
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(*keys).agg(agg.alias(name))


def rolling_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | None = None,
                name: str = "n", block_on: str | Column | None = None, n_blocks: int | None = None,
                block_source: DataFrame | None = None,
                min_rows_per_block: int = MIN_ROWS_PER_BLOCK) -> DataFrame:
    """One output per input record: the running sum (count when ``value`` is
    None) of its key up to and including itself, in ``order``.

    ``block_on`` (default: the first order column; a numeric column or
    expression, e.g. ``unix_micros(ts)``) is cut into monotone
    blocks to spread hot keys; its range is read from ``block_source``
    (default ``df``) -- pass the un-exploded input when ``df`` is derived by
    a flat-map, so the range scan stays cheap.
    """
    measure = F.lit(1).cast("long") if value is None else value
    return rolling_sums(df, keys, order, {name: measure}, block_on, n_blocks, block_source, min_rows_per_block)


def rolling_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 measures: Mapping[str, Column | tuple[str, Column]],
                 block_on: str | Column | None = None, n_blocks: int | None = None,
                 block_source: DataFrame | None = None,
                 min_rows_per_block: int = MIN_ROWS_PER_BLOCK, exclusive: bool = False) -> DataFrame:
    """:func:`rolling_sum` for several measures at once (one pass);
    ``("max", column)`` gives a running maximum, ``exclusive`` leaves the record itself out.  Heavy keys are cut into
    blocks, the others stay whole; an explicit ``n_blocks`` cuts every key."""
    cols = [F.col(c) for c in order]
    heavy = None
    if n_blocks is None:
        heavy, _ = heavy_keys(df, keys)
        if heavy is None:
            return running_totals(df, keys, cols, measures, exclusive)
    else:                             # an explicit block count is used as given
        min_rows_per_block = 1
    if block_on is None:
        block_on = order[0]
    n_blocks = n_blocks or default_blocks(df)
    block_val = F.col(block_on) if isinstance(block_on, str) else block_on
    blk = range_block(block_source if block_source is not None else df, block_val, n_blocks,
                      min_rows_per_block)
    return blocked_running_totals(df, keys, cols, blk, measures, heavy=heavy, exclusive=exclusive).drop(BLOCK)
