"""Event-time windows on streams: sessions and sliding windows with a
watermark, appended to a Parquet sink once closed.

Watermark mapping: a source that emits ``watermark = ts - lag`` closes a
window ``[s, e)`` once ``e - 1 <= watermark``; Spark closes it once
``e <= max_ts - delay``, so ``delay = lag - 1 ms`` gives the same closing
point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermark_delay_for_lag(lag_ms: int) -> str:
    return f"{max(lag_ms - 1, 0)} milliseconds"


def _real_rows(keys: Sequence[str]) -> Column:
    """Rows with at least one non-NULL key.  Filtering on this *aggregate*
    (rather than on the key) keeps Catalyst from pushing the filter below
    the watermark into the scan, where it would hide the replay sentinel
    from the watermark."""
    any_key = None
    for k in keys:
        c = F.col(k).isNotNull()
        any_key = c if any_key is None else any_key | c
    return F.count(F.when(any_key, 1)).alias("_real")


def stream_session_agg(stream: DataFrame, keys: Sequence[str], ts: str, gap: str, delay: str,
                       aggs: Mapping[str, Column]) -> DataFrame:
    """Append-mode sessions: ``(keys..., session_start, session_end, aggs...)``.
    Rows whose keys are all NULL (the replay sentinel) are dropped after the
    aggregation."""
    out = (stream.withWatermark(ts, delay)
           .groupBy(F.session_window(F.col(ts), gap).alias("_s"), *keys)
           .agg(_real_rows(keys), *[c.alias(n) for n, c in aggs.items()]))
    return out.where(F.col("_real") > 0).select(
        *keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), *aggs.keys())


def stream_sliding_agg(stream: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, delay: str,
                       aggs: Mapping[str, Column]) -> DataFrame:
    """Append-mode sliding windows: ``(keys..., window_start, window_end, aggs...)``."""
    out = (stream.withWatermark(ts, delay)
           .groupBy(F.window(F.col(ts), size, slide).alias("_w"), *keys)
           .agg(_real_rows(keys), *[c.alias(n) for n, c in aggs.items()]))
    return out.where(F.col("_real") > 0).select(
        *keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *aggs.keys())


def processing_time_sliding(stream: DataFrame, keys: Sequence[str], size: str, slide: str,
                            aggs: Mapping[str, Column]) -> DataFrame:
    """Processing-time windows: arrival time (``current_timestamp()``) as the
    window column, zero watermark delay.  Results depend on the wall clock
    by design."""
    arrived = stream.withColumn("_arrival", F.current_timestamp())
    return stream_sliding_agg(arrived, keys, "_arrival", size, slide, "0 seconds", aggs)
