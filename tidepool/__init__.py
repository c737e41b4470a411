"""tidepool: keyed stream-window operators on Spark DataFrames.

Batch operators take and return DataFrames; the streaming helpers build
Structured Streaming queries.  See README.md for the operator list and the
scale design.
"""

from .operators.count_window import count_window
from .operators.delta import delta_trigger_fires, delta_trigger_fires_sequential
from .operators.prefix import blocked_running_totals, range_block, running_count
from .operators.reduce import keyed_reduce, rolling_reduce, window_reduce
from .operators.rolling import keyed_totals, rolling_sum, rolling_sums
from .operators.session import session_windows
from .operators.time_window import sliding_window_agg
from .operators.tokenize import english_records, tokenize_tweets, tokenize_whitespace, tokenize_words
from .operators.trailing import max_by_record, trailing_max_at, trailing_time_max
from .session import apply_recommended_conf, local_session, materialize, ship_package, shared_dir
from .sinks.tuple_text import show, stream_show, stream_tuple_text, tuple_lines, write_noop, write_tuple_text
from .sources.records import (from_elements, from_tuples, json_records, keyed_range, parse_telemetry,
                              synthetic_keyed_range, telemetry_from_events, telemetry_lines, text_lines)
from .sources.tables import read_table, spread
from .streaming.counts import count_window_batches
from .streaming.replay import dropped_by_watermark, replay, sentinel_row
from .streaming.stateful import stream_count_window, stream_delta_fires, stream_rolling_count, stream_top_speed
from .streaming.windows import (processing_time_sliding, stream_session_agg, stream_sliding_agg,
                                watermark_delay_for_lag)

__all__ = [
    "count_window_batches", "rolling_reduce", "stream_show", "stream_tuple_text", "window_reduce",
    "apply_recommended_conf", "blocked_running_totals", "count_window", "delta_trigger_fires",
    "delta_trigger_fires_sequential", "stream_delta_fires",
    "dropped_by_watermark", "english_records", "from_elements", "from_tuples", "json_records",
    "keyed_range", "keyed_reduce", "keyed_totals", "local_session", "materialize", "max_by_record",
    "parse_telemetry", "processing_time_sliding", "range_block", "read_table", "replay", "rolling_sum",
    "rolling_sums", "running_count", "sentinel_row", "session_windows", "shared_dir", "ship_package", "show",
    "sliding_window_agg", "spread", "stream_count_window", "stream_rolling_count", "stream_session_agg",
    "stream_sliding_agg", "stream_top_speed", "synthetic_keyed_range", "telemetry_from_events",
    "telemetry_lines", "text_lines", "tokenize_tweets", "tokenize_whitespace", "tokenize_words",
    "trailing_max_at", "trailing_time_max", "tuple_lines", "watermark_delay_for_lag", "write_noop",
    "write_tuple_text",
]
