"""Registry of every implemented query: name → ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import event_jobs as E
from . import stream_jobs as S
from . import text_jobs as T

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # text / word count jobs
        "tokenize_words": T.tokenize_words_q,
        "flat_map_user": T.flat_map_user,
        "word_count": T.word_count,
        "word_count_rolling": T.word_count_rolling,
        "word_lengths_total": T.word_lengths_total,
        "count_window_sum_10_5": T.count_window_sum_10_5,
        "count_window_sum_6_1": T.count_window_sum_6_1,
        "count_window_tumbling_5": T.count_window_tumbling_5,
        # JSON records
        "json_language_filter": T.json_language_filter,
        "tokenize_tweets": T.tokenize_tweets_q,
        "json_english_word_count": T.json_english_word_count,
        "json_english_word_count_rolling": T.json_english_word_count_rolling,
        # text sink and text-line source
        "src_text_lines": T.src_text_lines,
        "sink_tuple_text": T.sink_tuple_text,
        # keyed values over events
        "sliding_time_sum": E.sliding_time_sum,
        "sliding_time_sum_panes": E.sliding_time_sum_panes,
        "tumbling_time_sum": E.tumbling_time_sum,
        "src_keyed_range": E.src_keyed_range,
        "keyed_range_sliding_sum": E.keyed_range_sliding_sum,
        "keyed_range_sliding_sum_dense": E.keyed_range_sliding_sum_dense,
        "session_window_sum": E.session_window_sum,
        "session_window_sum_hot": E.session_window_sum_hot,
        "keyed_running_sum": E.keyed_running_sum,
        "reduce_generic": E.reduce_generic,
        "keyed_running_sum_nulls": E.keyed_running_sum_nulls,
        "sliding_time_reduce": E.sliding_time_reduce,
        "rolling_reduce": E.rolling_reduce_q,
        "count_window_sum_events": E.count_window_sum_events,
        "count_window_sum_events_100_2": E.count_window_sum_events_100_2,
        "count_window_sum_hot": E.count_window_sum_hot,
        "max_by_record": E.max_by_record_q,
        # cars
        "parse_telemetry": E.parse_telemetry_q,
        "parse_telemetry_text": E.parse_telemetry_text,
        "odometer": E.odometer,
        "delta_trigger_fires": E.delta_trigger_fires_q,
        "delta_trigger_fires_sequential": E.delta_trigger_fires_sequential_q,
        "delta_trigger_change": E.delta_trigger_change,
        "delta_trigger_rise": E.delta_trigger_rise,
        "count_trigger_time_evictor": E.count_trigger_time_evictor,
        "delta_trigger_count_evictor": E.delta_trigger_count_evictor,
        "top_speed_disordered": E.top_speed_disordered,
        "late_rows_exact": E.late_rows_exact,
        "ascending_violations": E.ascending_violations,
        "map_user": E.map_user,
        "late_rows_exact_hot": E.late_rows_exact_hot,
        "trailing_time_max_ties": E.trailing_time_max_ties,
        "trailing_time_max": E.trailing_time_max_q,
        "trailing_time_max_panes": E.trailing_time_max_panes,
        "trailing_day_max": E.trailing_day_max,
        "top_speed": E.top_speed,
        # streaming forms (replayed slice by slice)
        "stream_session_sum": S.stream_session_sum,
        "stream_sliding_sum": S.stream_sliding_sum,
        "stream_count_window": S.stream_count_window,
        "stream_count_window_10_5": S.stream_count_window_10_5,
        "stream_text_sink": S.stream_text_sink,
        "stream_word_count": S.stream_word_count,
        "stream_word_count_rolling": S.stream_word_count_rolling,
        "stream_json_english_word_count": S.stream_json_english_word_count,
        "stream_top_speed": S.stream_top_speed,
        "stream_top_speed_text": S.stream_top_speed_text,
        "stream_count_window_sum_events": S.stream_count_window_sum_events,
        "stream_rolling_reduce": S.stream_rolling_reduce,
        "stream_sliding_reduce": S.stream_sliding_reduce,
        "stream_late_drop": S.stream_late_drop,
    }
    return q


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE

    sql = dict(ORACLE)
    # alternative plans and streaming forms must equal their batch forms
    for alt_key, batch_key in EQUIVALENTS.items():
        sql[alt_key] = ORACLE[batch_key]
    return sql


EQUIVALENTS = {
    "flat_map_user": "tokenize_words",
    "stream_session_sum": "session_window_sum",
    "stream_sliding_sum": "sliding_time_sum",
    "stream_count_window": "count_window_sum_6_1",
    "stream_count_window_10_5": "count_window_sum_10_5",
    "stream_word_count": "word_count",
    "stream_word_count_rolling": "word_count_rolling",
    "stream_json_english_word_count": "json_english_word_count",
    "sink_tuple_text": "word_count",
    "trailing_time_max_panes": "trailing_time_max",
    "parse_telemetry_text": "parse_telemetry",
    "delta_trigger_fires_sequential": "delta_trigger_fires",
    "stream_top_speed": "top_speed",
    "stream_count_window_sum_events": "count_window_sum_events",
    "stream_rolling_reduce": "rolling_reduce",
    "stream_sliding_reduce": "sliding_time_reduce",
}

FLAGSHIP = "session_window_sum"
