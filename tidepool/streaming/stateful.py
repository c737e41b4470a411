"""Per-record stateful stream operators (``applyInPandasWithState``).

These keep exact arrival-order semantics across micro-batches with bounded
state per key:

* count windows: the key's record count and its last ``size - 1`` values;
* top speed: odometer total, trigger reference point and the records of the
  trailing span only (trimmed on every batch, not only on fires, so state
  of parked cars stays small).

Within a micro-batch a key's rows arrive as several pandas chunks; all are
concatenated and sorted by the order columns before folding.  Order across
micro-batches is arrival order (a record older than one already processed
cannot be re-ordered).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _concat(chunks: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    pdf = pd.concat(list(chunks), ignore_index=True)
    return pdf.sort_values(list(order), kind="stable").reset_index(drop=True)


def stream_count_window(stream: DataFrame, key: str, order: Sequence[str], size: int, slide: int,
                        value: str | None = None, name: str = "n") -> DataFrame:
    """Sliding count window per key on a stream; one output row per fire:
    ``(key, order..., seq_in_key, name)``."""
    order = list(order)
    vcol = value or "_one"
    src = stream if value else stream.selectExpr("*", "1L AS _one")
    in_fields = {f.name: f for f in src.schema.fields}
    v_type = in_fields[vcol].dataType
    out_schema = T.StructType([in_fields[key], *[in_fields[c] for c in order],
                               T.StructField("seq_in_key", T.LongType()), T.StructField(name, v_type)])
    state_schema = T.StructType([T.StructField("count", T.LongType()),
                                 T.StructField("tail", T.ArrayType(v_type))])

    in_cols = [key, *order] + ([vcol] if value else [])

    def sorted_columns(chunks: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
        # plain numpy: the per-key call is the hot path of this operator
        parts = list(chunks)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        cols = {c: pdf[c].to_numpy() for c in in_cols}
        o = np.lexsort([cols[c] for c in reversed(order)])
        return {c: v[o] for c, v in cols.items()}

    def emit(cols: dict[str, np.ndarray], seq: np.ndarray, fires: np.ndarray, sums) -> pd.DataFrame:
        out = {c: cols[c][fires] for c in (key, *order)}
        out["seq_in_key"] = seq[fires]
        out[name] = sums
        return pd.DataFrame(out)

    def fold(k, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cols = sorted_columns(chunks)
        count, tail = (state.get if state.exists else (0, []))
        tail = list(tail or [])
        allv = tail + cols[vcol].tolist()
        seq = np.arange(count + 1, count + len(cols[key]) + 1, dtype=np.int64)
        fires = np.nonzero(seq % slide == 0)[0]
        # window sums as prefix-sum differences (exact for integral values)
        csum = np.concatenate([[0], np.cumsum(np.asarray(allv, dtype=object))])
        ends = len(tail) + fires + 1
        sums = list(csum[ends] - csum[np.maximum(0, ends - size)])
        state.update((int(seq[-1]), allv[-(size - 1):] if size > 1 else []))
        yield emit(cols, seq, fires, sums)

    def fold_count(k, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # counting: the window count is least(ordinal, size); only the
        # key's record count is state
        cols = sorted_columns(chunks)
        count = state.get[0] if state.exists else 0
        seq = np.arange(count + 1, count + len(cols[key]) + 1, dtype=np.int64)
        fires = np.nonzero(seq % slide == 0)[0]
        state.update((int(seq[-1]), None))
        yield emit(cols, seq, fires, np.minimum(seq[fires], size))

    return src.select(*in_cols).groupBy(key).applyInPandasWithState(
        fold if value else fold_count, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def stream_rolling_count(stream: DataFrame, key: str, order: Sequence[str], name: str = "n") -> DataFrame:
    """Per-record running count of each key on a stream (one output row per
    input record): the count window with slide 1 and no size limit.  For many
    keys ``counts.count_window_batches`` gives the same without Python."""
    out = stream_count_window(stream, key, order, 2**62, 1, None, name)
    return out.drop("seq_in_key")


def stream_top_speed(stream: DataFrame, key: str, ts_us: str, seq: str, speed_centi: str, speed: str,
                     threshold: int, span_us: int) -> DataFrame:
    """Streaming top speed.  Input columns: key, event time in µs, seq,
    speed in exact 1/100 units, speed.  Output per fire:
    ``(key, fire_seq, top_seq, top_speed, top_dist_c, top_ts_us)``."""
    in_fields = {f.name: f for f in stream.schema.fields}
    out_schema = T.StructType([
        in_fields[key], T.StructField("fire_seq", T.LongType()), T.StructField("top_seq", T.LongType()),
        T.StructField("top_speed", T.DoubleType()), T.StructField("top_dist_c", T.LongType()),
        T.StructField("top_ts_us", T.LongType())])
    state_schema = T.StructType([
        T.StructField("dist", T.LongType()), T.StructField("ref", T.LongType()),
        T.StructField("buf_t", T.ArrayType(T.LongType())), T.StructField("buf_seq", T.ArrayType(T.LongType())),
        T.StructField("buf_speed", T.ArrayType(T.DoubleType())), T.StructField("buf_d", T.ArrayType(T.LongType()))])

    def fold(k, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _concat(chunks, [ts_us, seq])
        if state.exists:
            dist, ref, bt, bs, bv, bd = state.get
        else:
            dist, ref, bt, bs, bv, bd = 0, None, [], [], [], []
        d = dist + np.cumsum(pdf[speed_centi].to_numpy(dtype=np.int64))
        t = pdf[ts_us].to_numpy(dtype=np.int64)
        s = pdf[seq].to_numpy(dtype=np.int64)
        v = pdf[speed].to_numpy(dtype=np.float64)
        start = 0
        if ref is None:          # the key's first record: reference point, no fire
            ref, start = int(d[0]), 1
        nxt = np.searchsorted(d, d + threshold, side="right")
        fires = []
        j = max(start, int(np.searchsorted(d, ref + threshold, side="right")))
        while j < len(d):
            fires.append(j)
            j = int(nxt[j])
        if fires:
            ref = int(d[fires[-1]])
        all_t = np.concatenate([np.asarray(bt or [], dtype=np.int64), t])
        all_s = np.concatenate([np.asarray(bs or [], dtype=np.int64), s])
        all_v = np.concatenate([np.asarray(bv or [], dtype=np.float64), v])
        all_d = np.concatenate([np.asarray(bd or [], dtype=np.int64), d])
        off = len(all_t) - len(t)
        rows = []
        for f in fires:
            hi = off + f
            lo = int(np.searchsorted(all_t[: hi + 1], all_t[hi] - span_us, side="right"))
            m = lo + int(np.argmax(all_v[lo: hi + 1]))      # first max = earliest
            rows.append((k[0], int(s[f]), int(all_s[m]), float(all_v[m]), int(all_d[m]), int(all_t[m])))
        keep = all_t > all_t[-1] - span_us
        state.update((int(d[-1]), ref, all_t[keep].tolist(), all_s[keep].tolist(),
                      all_v[keep].tolist(), all_d[keep].tolist()))
        yield pd.DataFrame(rows, columns=[f.name for f in out_schema.fields])

    return stream.select(key, ts_us, seq, speed_centi, speed).groupBy(key).applyInPandasWithState(
        fold, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def stream_delta_fires(stream: DataFrame, key: str, ts_us: str, seq: str, measure: str,
                       threshold: float, delta: Callable | None = None) -> DataFrame:
    """Delta-trigger fires for *any* measure (not only non-decreasing ones):
    per key, the first record is the reference, a record fires when
    ``delta(reference, measure) > threshold`` and becomes the reference.
    ``delta`` is a Python function of two values (default: the second minus
    the first).  State is the reference value only.  Output: ``(key, seq, ts_us, measure)`` per fire."""
    in_fields = {f.name: f for f in stream.schema.fields}
    out_schema = T.StructType([in_fields[key], in_fields[seq], in_fields[ts_us], in_fields[measure]])
    exact = isinstance(in_fields[measure].dataType, T.IntegralType)
    state_schema = T.StructType([T.StructField("ref", T.LongType() if exact else T.DoubleType())])

    change = delta or (lambda old, new: new - old)

    def fold(k, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = _concat(chunks, [ts_us, seq])
        if pdf[measure].isna().any():
            raise ValueError("delta trigger: the measure must not be NULL or NaN")
        d = pdf[measure].astype("int64" if exact else "float64").tolist()
        ref = state.get[0] if state.exists else None
        fires = []
        for i in range(len(d)):          # sequential by definition
            if ref is None:
                ref = d[i]
            elif change(ref, d[i]) > threshold:
                fires.append(i)
                ref = d[i]
        state.update((ref,))
        yield pdf.iloc[fires][[key, seq, ts_us, measure]]

    return stream.select(key, ts_us, seq, measure).groupBy(key).applyInPandasWithState(
        fold, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)
