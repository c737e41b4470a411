"""Independent DuckDB SQL for every registered query.

Each string runs on DuckDB with the Parquet tables registered as views and
returns the same column names as the Spark plan.
"""

from __future__ import annotations

# Token relations shared by several oracles --------------------------------

_WORDS = r"""
words AS (
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM (
    SELECT doc_id,
           unnest(range(len(regexp_split_to_array(lower(text), '\W+')))) AS pos,
           unnest(regexp_split_to_array(lower(text), '\W+')) AS word
    FROM documents)
  WHERE length(word) > 0
)"""

_TWEET_WORDS = """
tweet_words AS (
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM (
    SELECT doc_id, pos, lower(regexp_replace(piece, '[ \t\n\x0B\f\r]', '', 'g')) AS word FROM (
      SELECT doc_id,
             unnest(range(len(regexp_split_to_array(text, '[ \t\n\r\f]+')))) AS pos,
             unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS piece
      FROM documents WHERE lang = 'en' AND text IS NOT NULL))
  WHERE length(word) > 0
)"""


def _count_window(size: int, slide: int) -> str:
    return f"""WITH {_WORDS},
r AS (
  SELECT word, doc_id, pos,
         row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS seq_in_key,
         count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
                        ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) AS n
  FROM words)
SELECT word, doc_id, pos, seq_in_key, n FROM r WHERE seq_in_key % {slide} = 0"""


ORACLE: dict[str, str] = {
    "tokenize_words": f"WITH {_WORDS} SELECT doc_id, pos, word FROM words",
    "word_count": f"WITH {_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
    "word_count_rolling": f"""WITH {_WORDS}
SELECT doc_id, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS n
FROM words""",
    "src_text_lines": f"WITH {_WORDS} SELECT '(' || word || ',' || count(*) || ')' AS line FROM words GROUP BY word",
    "word_lengths_total": f"WITH {_WORDS} SELECT word, CAST(sum(length(word)) AS BIGINT) AS chars FROM words GROUP BY word",
    "count_window_sum_10_5": _count_window(10, 5),
    "count_window_sum_6_1": _count_window(6, 1),
    "count_window_tumbling_5": _count_window(5, 5),
    "json_language_filter": "SELECT doc_id, text FROM documents WHERE lang = 'en' AND text IS NOT NULL",
    "tokenize_tweets": f"WITH {_TWEET_WORDS} SELECT doc_id, pos, word FROM tweet_words",
    "json_english_word_count": f"WITH {_TWEET_WORDS} SELECT word, count(*) AS n FROM tweet_words GROUP BY word",
    "json_english_word_count_rolling": f"""WITH {_TWEET_WORDS}
SELECT doc_id, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS n
FROM tweet_words""",
}


# events -------------------------------------------------------------------

def _windows(size_us: int, slide_us: int) -> str:
    k = size_us // slide_us
    return f"""WITH e AS (SELECT user_id, epoch_us(ts) AS t, value FROM events),
w AS (SELECT user_id, (t // {slide_us} - k) * {slide_us} AS s, value FROM e, range(0, {k}) r(k))
SELECT user_id, make_timestamp(s) AS window_start, make_timestamp(s + {size_us}) AS window_end,
       count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM w GROUP BY user_id, s"""


def _events_count_window(size: int, slide: int) -> str:
    return f"""WITH r AS (
  SELECT user_id, ts, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq_in_key,
         sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) AS vs
  FROM events)
SELECT user_id, ts, event_id, seq_in_key, CAST(vs AS DOUBLE) AS value_sum FROM r
WHERE seq_in_key % {slide} = 0"""


_ODO = """o AS (
  SELECT event_id AS seq, CAST(user_id % 8 AS INTEGER) AS car_id, value AS speed, ts, epoch_us(ts) AS t,
         CAST(dc AS BIGINT) AS dist_c, CAST(dc AS DOUBLE) / 360.0 AS distance,
         row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) AS rn
  FROM (SELECT *, sum(CAST(round(value * 100) AS BIGINT))
                    OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS dc
        FROM events))"""

_FIRES = """nx AS (
  SELECT a.car_id, a.rn, min(b.rn) AS nxt FROM o a JOIN o b
    ON a.car_id = b.car_id AND b.dist_c > a.dist_c + 18000
  GROUP BY a.car_id, a.rn),
chain(car_id, rn) AS (
  SELECT car_id, nxt FROM nx WHERE rn = 1
  UNION ALL
  SELECT n.car_id, n.nxt FROM chain c JOIN nx n ON n.car_id = c.car_id AND n.rn = c.rn),
fires AS (SELECT o.* FROM o JOIN chain c ON o.car_id = c.car_id AND o.rn = c.rn)"""

_TRAILING = """tr AS (
  SELECT o.seq, o.car_id, o.speed, o.ts, o.dist_c, o.distance,
         x.top_seq, x.top_speed, x.top_distance, x.top_ts
  FROM o, LATERAL (
    SELECT o2.seq AS top_seq, o2.speed AS top_speed, o2.distance AS top_distance, o2.ts AS top_ts
    FROM o o2
    WHERE o2.car_id = o.car_id AND o2.t > o.t - 3600000000 AND o2.t <= o.t
    ORDER BY o2.speed DESC, o2.t, o2.seq LIMIT 1) x)"""

ORACLE.update({
    "sliding_time_sum": _windows(2500 * 10**6, 500 * 10**6),
    "sliding_time_sum_panes": _windows(3600 * 10**6, 60 * 10**6),
    "tumbling_time_sum": _windows(3600 * 10**6, 3600 * 10**6),
    "src_keyed_range": """SELECT event_id AS seq, event_id % 10000 + 1 AS key, CAST(1 AS BIGINT) AS value,
       make_timestamp(event_id * 1000) AS arrival FROM events""",
    "keyed_range_sliding_sum": """WITH w AS (
  SELECT event_id % 10000 + 1 AS key, (event_id * 1000 // 500000 - k) * 500000 AS s
  FROM events, range(0, 5) r(k))
SELECT key, make_timestamp(s) AS window_start, make_timestamp(s + 2500000) AS window_end,
       CAST(count(*) AS BIGINT) AS value
FROM w GROUP BY key, s""",
    "keyed_range_sliding_sum_dense": """WITH w AS (
  SELECT event_id % 100 + 1 AS key, (event_id * 1000 // 500000 - k) * 500000 AS s
  FROM events, range(0, 5) r(k))
SELECT key, make_timestamp(s) AS window_start, make_timestamp(s + 2500000) AS window_end,
       CAST(count(*) AS BIGINT) AS value
FROM w GROUP BY key, s""",
    "session_window_sum": """WITH e AS (SELECT user_id, epoch_us(ts) AS t, event_id, event_type, value FROM events),
f AS (SELECT *, lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS pt FROM e),
g AS (SELECT *, sum(CASE WHEN pt IS NULL OR t - pt > 3600000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, make_timestamp(min(t)) AS session_start, make_timestamp(max(t) + 3600000000) AS session_end,
       min(event_id) AS first_event_id, arg_min(event_type, event_id) AS first_event_type,
       count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM g GROUP BY user_id, sid""",
    "keyed_running_sum": """SELECT event_id, ts, user_id, value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_value
FROM events""",
    "reduce_generic": """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY user_id""",
    "count_window_sum_events": _events_count_window(10, 5),
    "count_window_sum_events_100_2": _events_count_window(100, 2),
    "max_by_record": """SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS rn FROM events)
WHERE rn = 1""",
    "parse_telemetry": """SELECT event_id AS seq, CAST(user_id % 8 AS INTEGER) AS car_id,
       CAST(floor(value) AS INTEGER) AS speed, value AS distance, epoch_us(ts) // 1000 AS ts_ms,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts
FROM events""",
    "odometer": f"WITH {_ODO} SELECT seq, car_id, speed, ts, dist_c, distance FROM o",
    "delta_trigger_fires": f"""WITH RECURSIVE {_ODO}, {_FIRES}
SELECT seq, car_id, speed, ts, dist_c, distance FROM fires""",
    "trailing_time_max": f"WITH {_ODO}, {_TRAILING} SELECT * FROM tr",
    "top_speed": f"""WITH RECURSIVE {_ODO}, {_FIRES}, {_TRAILING}
SELECT tr.car_id, tr.seq AS fire_seq, tr.top_seq, tr.top_speed, tr.top_distance, tr.top_ts
FROM tr JOIN fires f ON tr.car_id = f.car_id AND tr.seq = f.seq""",
})


# Late rows: quartile slices of the event time range replayed in the order
# 0, 2, 3, 1 with a 1 h watermark delay -- the whole second quartile arrives
# behind the watermark and is dropped; the rest is counted per 1 h window.
ORACLE["stream_late_drop"] = """WITH e AS (SELECT event_type, epoch_us(ts) AS t FROM events),
b AS (SELECT min(t) AS lo, (CAST(max(t) AS DOUBLE) - CAST(min(t) AS DOUBLE)) / 4 AS span FROM e),
s AS (SELECT e.event_type, e.t, least(floor((e.t - b.lo) / b.span), 3) AS slice FROM e, b)
SELECT event_type, make_timestamp(t // 3600000000 * 3600000000) AS window_start,
       make_timestamp(t // 3600000000 * 3600000000 + 3600000000) AS window_end, count(*) AS n
FROM s WHERE slice <> 1 GROUP BY event_type, t // 3600000000"""


ORACLE.update({
    "stream_text_sink": f"SELECT word, n FROM ({_count_window(10, 5)})",
    "sliding_time_reduce": f"SELECT user_id, window_start, window_end, value_sum FROM ({_windows(2500 * 10**6, 500 * 10**6)})",
    # the first event of a running maximum: the last one that raised it
    "rolling_reduce": """WITH e AS (
  SELECT event_id, event_type, ts, value, max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old FROM events)
SELECT event_id, event_type, greatest(value, old) AS top,
       last_value(CASE WHEN old IS NULL OR value > old THEN event_id END IGNORE NULLS) OVER (
         PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS top_id
FROM e""",
    "keyed_running_sum_nulls": """SELECT event_id, event_type,
       CAST(sum(CASE WHEN event_id % 3 <> 0 THEN CAST(value AS DECIMAL(18,2)) END) OVER (
            PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_value
FROM events""",
    "trailing_time_max_ties": """WITH o AS (
  SELECT event_id AS seq, CAST(user_id % 8 AS INTEGER) AS car_id, value AS speed,
         epoch_us(ts) // 3600000000 AS h FROM events)
SELECT o.car_id, o.seq, x.top_seq, x.top_speed FROM o, LATERAL (
  SELECT o2.seq AS top_seq, o2.speed AS top_speed FROM o o2
  WHERE o2.car_id = o.car_id AND o2.h > o.h - 6 AND (o2.h < o.h OR (o2.h = o.h AND o2.seq <= o.seq))
  ORDER BY o2.speed DESC, o2.h, o2.seq LIMIT 1) x""",
    "delta_trigger_change": """WITH RECURSIVE o AS (
  SELECT CAST(user_id % 8 AS INTEGER) AS car_id, event_id AS seq, ts, CAST(round(value * 100) AS BIGINT) AS speed_c,
         row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts, event_id) AS rn FROM events),
f AS (
  SELECT car_id, seq, ts, speed_c, rn, speed_c AS ref, FALSE AS fire FROM o WHERE rn = 1
  UNION ALL
  SELECT o.car_id, o.seq, o.ts, o.speed_c, o.rn,
         CASE WHEN abs(o.speed_c - f.ref) > 2500 THEN o.speed_c ELSE f.ref END, abs(o.speed_c - f.ref) > 2500
  FROM f JOIN o ON o.car_id = f.car_id AND o.rn = f.rn + 1)
SELECT car_id, seq, ts, speed_c FROM f WHERE fire""",
})


# A third of all events with one user.
_HOT = "(SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, event_type, value FROM events)"

# Arrival up to 90 minutes after the event; the odometer follows event time.
_ARRIVED = """a AS (
  SELECT o.* EXCLUDE (rn), row_number() OVER w AS rn, max(t) OVER (w ROWS UNBOUNDED PRECEDING) AS mx
  FROM (SELECT *, t + (seq * 7919 % 5400) * 1000000 AS arrived FROM o) o
  WINDOW w AS (PARTITION BY car_id ORDER BY arrived, seq))"""

ORACLE.update({
    "session_window_sum_hot": ORACLE["session_window_sum"].replace("FROM events", f"FROM {_HOT}").replace("3600000000", "600000000"),
    "count_window_sum_hot": ORACLE["count_window_sum_events_100_2"].replace("FROM events", f"FROM {_HOT}"),
    "delta_trigger_rise": """WITH RECURSIVE o AS (
  SELECT event_type, event_id, ts, CAST(round(value * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
f AS (
  SELECT event_type, event_id, ts, cents, rn, cents AS ref, FALSE AS fire FROM o WHERE rn = 1
  UNION ALL
  SELECT o.event_type, o.event_id, o.ts, o.cents, o.rn,
         CASE WHEN o.cents - f.ref > 500 THEN o.cents ELSE f.ref END, o.cents - f.ref > 500
  FROM f JOIN o ON o.event_type = f.event_type AND o.rn = f.rn + 1)
SELECT event_type, ts, event_id, cents FROM f WHERE fire""",
    "top_speed_disordered": f"""WITH RECURSIVE {_ODO}, {_ARRIVED},
f AS (
  SELECT car_id, seq, rn, mx, dist_c AS ref, FALSE AS fire FROM a WHERE rn = 1
  UNION ALL
  SELECT a.car_id, a.seq, a.rn, a.mx, CASE WHEN a.dist_c - f.ref > 18000 THEN a.dist_c ELSE f.ref END, a.dist_c - f.ref > 18000
  FROM f JOIN a ON a.car_id = f.car_id AND a.rn = f.rn + 1)
SELECT f.car_id, f.seq AS fire_seq, x.* FROM f, LATERAL (
  SELECT count(*) AS n_records, first(a.seq ORDER BY a.speed DESC, a.rn) AS top_seq, first(a.speed ORDER BY a.speed DESC, a.rn) AS top_speed,
         first(a.distance ORDER BY a.speed DESC, a.rn) AS top_distance, first(a.ts ORDER BY a.speed DESC, a.rn) AS top_ts
  FROM a WHERE a.car_id = f.car_id AND a.rn <= f.rn AND a.t > f.mx - 3600000000) x
WHERE f.fire""",
    "count_trigger_time_evictor": f"""WITH {_ODO}, {_ARRIVED}
SELECT f.car_id, f.seq AS fire_seq, f.rn AS seq_in_key, x.* FROM a f, LATERAL (
  SELECT count(*) AS n_records, CAST(sum(CAST(a.speed AS DECIMAL(18,2))) AS DOUBLE) AS speed_sum, first(a.seq ORDER BY a.speed DESC, a.rn) AS top_seq
  FROM a WHERE a.car_id = f.car_id AND a.rn <= f.rn AND a.t > f.mx - 21600000000) x
WHERE f.rn % 25 = 0""",
    "delta_trigger_count_evictor": f"""WITH RECURSIVE {_ODO}, {_FIRES}
SELECT f.car_id, f.seq AS fire_seq, f.rn AS seq_in_key, count(*) AS n_records, CAST(sum(CAST(o.speed AS DECIMAL(18,2))) AS DOUBLE) AS speed_sum
FROM fires f JOIN o ON o.car_id = f.car_id AND o.rn <= f.rn AND o.rn > f.rn - 20 GROUP BY f.car_id, f.seq, f.rn""",
})


def _late_rows(key: str) -> str:
    """Sessions of a key in order of arrival, as a list that each row changes."""
    live = "list_filter(f.act, lambda x: x.e - 1 > w.wm)"
    met = "list_filter(f.act, lambda x: x.e - 1 > w.wm AND x.s <= w.t + 1800000 AND x.e >= w.t)"
    start = f"least(w.t, coalesce(list_min([x.s FOR x IN {met}]), w.t))"
    end = f"greatest(w.t + 1800000, coalesce(list_max([x.e FOR x IN {met}]), w.t))"
    rest = "list_filter(f.act, lambda x: x.e - 1 > w.wm AND NOT (x.s <= w.t + 1800000 AND x.e >= w.t))"
    return f"""WITH RECURSIVE e AS (
  SELECT event_id, {key}, epoch_us(ts) // 1000 AS t, epoch_us(ts) + (event_id * 7919 % 5400) * 1000000 AS arrived FROM events),
w AS (SELECT *, max(t) OVER (ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1200000 AS wm,
             row_number() OVER (PARTITION BY {key} ORDER BY arrived, event_id) AS rn FROM e),
f AS (
  SELECT event_id, {key}, t, wm, rn, coalesce(t + 1799999 <= wm, FALSE) AS late,
         CASE WHEN t + 1799999 <= wm THEN [] ELSE [{{'s': t, 'e': t + 1800000}}] END AS act FROM w WHERE rn = 1
  UNION ALL
  SELECT w.event_id, w.{key}, w.t, w.wm, w.rn, {end} - 1 <= w.wm,
         CASE WHEN {end} - 1 <= w.wm THEN {live} ELSE list_append({rest}, {{'s': {start}, 'e': {end}}}) END
  FROM f JOIN w ON w.{key} = f.{key} AND w.rn = f.rn + 1)
SELECT event_id, {key}, t AS t_ms, wm AS watermark, late FROM f"""


ORACLE.update({"late_rows_exact": _late_rows("user_id"), "late_rows_exact_hot": _late_rows("event_type")})

ORACLE["map_user"] = f"SELECT seq, car_id, speed, distance, ts_ms FROM ({ORACLE['parse_telemetry']})"
ORACLE["ascending_violations"] = """WITH a AS (
  SELECT event_id AS seq, CAST(user_id % 8 AS INTEGER) AS car_id, epoch_us(ts) AS t_us,
         epoch_us(ts) + (event_id * 7919 % 5400) * 1000000 AS arrived FROM events),
w AS (SELECT *, max(t_us) OVER (ORDER BY arrived, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_us FROM a)
SELECT seq, car_id, t_us, latest_us FROM w WHERE t_us < latest_us"""

ORACLE["trailing_day_max"] = """WITH o AS (
  SELECT event_id AS seq, CAST(user_id % 8 AS INTEGER) AS car_id, value AS speed, epoch_us(ts) AS t FROM events)
SELECT o.car_id, o.seq, x.top_seq, x.top_speed FROM o, LATERAL (
  SELECT o2.seq AS top_seq, o2.speed AS top_speed FROM o o2
  WHERE o2.car_id = o.car_id AND o2.t > o.t - 86400000000 AND (o2.t < o.t OR (o2.t = o.t AND o2.seq <= o.seq))
  ORDER BY o2.speed DESC, o2.t, o2.seq LIMIT 1) x"""

# The car lines carry whole km/h and milliseconds.
_CAR_LINES = "(SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, user_id, floor(value) AS value FROM events)"
ORACLE["stream_top_speed_text"] = f"""WITH RECURSIVE {_ODO.replace("FROM events", f"FROM {_CAR_LINES}")}, {_FIRES}, {_TRAILING}
SELECT tr.car_id, f.ts AS fire_ts, tr.top_speed, tr.top_ts, tr.top_distance
FROM tr JOIN fires f ON tr.car_id = f.car_id AND tr.seq = f.seq"""
