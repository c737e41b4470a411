"""Record-returning max and the trailing-time-span max per key.

``maxBy`` semantics: the whole record holding the maximum; on ties the
earliest record (lowest ``(ts, tiebreak)``).

The trailing span of a record is ``(ts - span, ts]`` (a record exactly
``span`` old is out).  A window ``partitionBy(key)`` would put a hot key in
one task, so time is cut into blocks of at least ``span``: each block also
receives copies of the previous block's last ``span`` of records (the
halo), the RANGE-frame max runs per ``(key, block)``, and only the block's
own records are kept.  Halo copies are bounded by one span per block edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import BLOCK, MIN_ROWS_PER_BLOCK, default_blocks, null_safe_join


def record_order(value: str, ts: str, tiebreak: Sequence[str]) -> Column:
    """Ordering struct for max-by: larger value first, then earlier record."""
    return F.struct(F.col(value), F.negative(F.unix_micros(F.col(ts).cast("timestamp"))),
                    *[F.negative(F.col(c)) for c in tiebreak])


def max_by_record(df: DataFrame, keys: Sequence[str], value: str, fields: Sequence[str], ts: str,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per key, the record with the largest ``value`` (earliest on ties):
    ``(keys..., fields...)``.  A plain grouped aggregate: partial
    ``max_by`` before the exchange keeps hot keys cheap."""
    rec = F.max_by(F.struct(*[F.col(c) for c in fields]), record_order(value, ts, tiebreak))
    return df.groupBy(*keys).agg(rec.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in fields])


def trailing_time_max(df: DataFrame, keys: Sequence[str], ts: str, span_us: int, value: str,
                      fields: Sequence[str], tiebreak: Sequence[str] = (), prefix: str = "top_",
                      n_blocks: int | None = None, min_rows_per_block: int = MIN_ROWS_PER_BLOCK,
                      block_source: DataFrame | None = None, strategy: str = "auto") -> DataFrame:
    """Every record plus ``prefix + field`` columns of the max-``value``
    record in its trailing span (earliest on ties).

    Two plans:

    * ``frame`` -- a RANGE-frame ``max_by`` per ``(key, time block)`` with a
      halo; Spark re-evaluates the frame per row (cost records × records
      per span), and records of one key with equal ``ts`` are peers;
    * ``panes`` -- :func:`_trailing_max_panes`, linear in the records and
      exact for equal timestamps (arrival order by ``tiebreak``).

    ``auto`` is ``panes``: the answer must not depend on the table's size, and
    only ``panes`` never shows a record a later peer.  ``block_source``
    (default ``df``) supplies the time range of ``frame``.
    """
    keys = list(keys)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    base = df.withColumn("_t", t)
    if strategy in ("auto", "panes"):
        return _trailing_max_panes(df, keys, ts, span_us, value, fields, tiebreak, prefix)
    if strategy != "frame":
        raise ValueError(f"unknown strategy {strategy!r}")
    stats = base if block_source is None else block_source.select(t.alias("_t"))
    lo, hi, n = stats.select(F.min("_t"), F.max("_t"), F.count("_t")).first()
    if n_blocks is None:              # an explicit block count is used as given
        n_blocks = max(1, min(default_blocks(df), n // max(1, min_rows_per_block)))
    width = max(span_us, ((hi - lo) // n_blocks + 1) if lo is not None else span_us)
    blk = F.floor(F.col("_t") / F.lit(width)).cast("long")
    own = base.withColumn(BLOCK, blk).withColumn("_halo", F.lit(False))
    # copies of each block's last `span` of records, handed to the next block
    next_start = (F.col(BLOCK) + 1) * F.lit(width)
    halo = (own.where(F.col("_t") > next_start - F.lit(span_us))
            .withColumn(BLOCK, F.col(BLOCK) + 1).withColumn("_halo", F.lit(True)))
    both = own.unionByName(halo)
    w = (Window.partitionBy(*keys, BLOCK).orderBy(F.col("_t"))
         .rangeBetween(-(span_us - 1), Window.currentRow))
    top = F.max_by(F.struct(*[F.col(c) for c in fields]), record_order(value, ts, tiebreak)).over(w)
    out = both.withColumn("_top", top).where(~F.col("_halo"))
    return out.select(*df.columns, *[F.col(f"_top.{c}").alias(prefix + c) for c in fields])


def _trailing_max_panes(df: DataFrame, keys: Sequence[str], ts: str, span_us: int, value: str,
                        fields: Sequence[str], tiebreak: Sequence[str], prefix: str) -> DataFrame:
    """Trailing-span max in linear time.

    With panes of width ``span``, the span ``(t - span, t]`` of a record in
    pane ``P`` is a *prefix* of pane ``P`` (up to the record, in arrival
    order) plus a *suffix* of pane ``P - 1`` (records later than
    ``t - span``).  Per ``(key, pane)`` a running ``max_by`` gives every
    prefix and a reversed running ``max_by`` every suffix (both incremental
    window frames).  The suffix that starts right after ``t - span`` is found
    by an as-of lookup: each record is sent, as a query at time
    ``t - span``, into pane ``P - 1`` and sorted together with that pane's
    records by descending time; the last suffix seen before the query is
    the one wanted.  Two exchanges, sorts, no per-row frame re-evaluation.
    """
    keys = list(keys)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    ordv = record_order(value, ts, tiebreak)
    item = F.struct(ordv.alias("o"), F.struct(*[F.col(c) for c in fields]).alias("r"))
    base = df.withColumn("_t", t).withColumn("_p", F.floor(F.col("_t") / F.lit(span_us)).cast("long"))
    arrival = [F.col("_t"), *[F.col(c) for c in tiebreak]]
    w_pre = Window.partitionBy(*keys, "_p").orderBy(*arrival).rowsBetween(Window.unboundedPreceding, 0)
    w_suf = Window.partitionBy(*keys, "_p").orderBy(*[c.desc() for c in arrival]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    runs = base.withColumn("_pre", F.max_by(item, ordv).over(w_pre)).withColumn(
        "_suf", F.max_by(item, ordv).over(w_suf))
    tb = [F.col(c) for c in tiebreak]
    data = runs.select(*keys, "_p", F.col("_t").alias("_at"), F.lit(0).alias("_q"),
                       *[c.alias(f"_tb{i}") for i, c in enumerate(tb)], "_suf")
    queries = runs.select(*keys, (F.col("_p") - 1).alias("_p"), (F.col("_t") - F.lit(span_us)).alias("_at"),
                          F.lit(1).alias("_q"), *[F.lit(None).cast(runs.schema[c].dataType).alias(f"_tb{i}")
                                                  for i, c in enumerate(tiebreak)],
                          F.lit(None).cast(runs.schema["_suf"].dataType).alias("_suf"),
                          F.struct(*[F.col(c) for c in df.columns]).alias("_row"), "_pre")
    both = data.unionByName(queries, allowMissingColumns=True)
    # descending time; a query precedes records at its own time (they are
    # exactly `span` old and out of its frame)
    w_asof = Window.partitionBy(*keys, "_p").orderBy(
        F.col("_at").desc(), F.col("_q").desc(), *[F.col(f"_tb{i}").desc() for i in range(len(tiebreak))]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_old", F.last("_suf", ignorenulls=True).over(w_asof)).where(F.col("_q") == 1)
    best = F.when(F.col("_old").isNull() | (F.col("_pre.o") >= F.col("_old.o")), F.col("_pre")) \
        .otherwise(F.col("_old"))
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns],
                        *[best.getField("r").getField(c).alias(prefix + c) for c in fields])


def trailing_max_at(points: DataFrame, records: DataFrame, keys: Sequence[str], ts: str, seq: str, span_us: int,
                    value: str, fields: Sequence[str], prefix: str = "top_",
                    full_rows: bool = True) -> DataFrame:
    """For each row of ``points`` (records at which a report is due, e.g.
    trigger fires), ``prefix + field`` columns of the max-``value`` record
    among ``records`` of the same key that arrived no later (``(ts, seq)``
    order) within ``(ts - span, ts]`` (earliest on ties).

    Linear in both, however many records a span holds.  With panes of width
    ``span``, the span of a point in pane ``P`` is the part of pane ``P`` up to
    the point (in ``(ts, seq)`` order) and the part of pane ``P - 1`` later than
    ``ts - span``.  Each point is sent into both panes and sorted among their
    records; a running maximum in ascending order answers it in the one, in
    descending order in the other.  Records cross one exchange on ``(key,
    pane)``, which spreads a hot key over its time range; the better of a
    point's two answers takes an exchange of the points alone.
    With ``full_rows=False`` only ``(keys..., seq, prefix + fields...)`` come
    back, for points that are records themselves (each then has a maximum),
    and ``points`` is read once.
    """
    keys = list(keys)
    t_us = F.unix_micros(F.col(ts).cast("timestamp"))
    rec_cols = list(dict.fromkeys([*fields, value, seq]))
    rec = F.struct(*[F.col(c) for c in rec_cols])
    at = F.col("_at")

    def pane(c: Column) -> Column:
        return F.floor(c / F.lit(span_us)).cast("long")

    recs = records.select(*keys, F.col(seq).alias("_s"), t_us.alias("_at"), F.lit(0).alias("_q"), rec.alias("_r"))
    recs = recs.where(at.isNotNull()).withColumn("_p", pane(at))
    # 1 looks up to itself, 2 looks beyond ``ts - span`` of the pane before
    asks = points.select(*keys, F.col(seq).alias("_s"), t_us.alias("_t")).where(F.col("_t").isNotNull())
    asks = asks.withColumn("_a", F.explode(F.array(
        F.struct(F.col("_t").alias("_at"), F.lit(1).alias("_q")),
        F.struct((F.col("_t") - F.lit(span_us)).alias("_at"), F.lit(2).alias("_q"))))).select(*keys, "_s", "_a.*")
    both = recs.unionByName(asks.withColumn("_p", pane(at)), allowMissingColumns=True)
    # at one time: a record without ``seq`` is never seen, a point without one sees none
    unknown = F.when(F.col("_q") == 0, F.lit(2)).otherwise(F.lit(0))
    rank = F.when(F.col("_s").isNull(), unknown).otherwise(F.lit(1))
    order = F.when(F.col("_q") == 0, F.struct(F.col(f"_r.{value}").alias("v"), F.negative(at).alias("t"), F.negative(F.col("_s")).alias("s")))
    w = Window.partitionBy(*keys, "_p")
    up = w.orderBy(at, rank, "_s", "_q").rowsBetween(Window.unboundedPreceding, 0)
    down = w.orderBy(at.desc(), F.col("_q").desc()).rowsBetween(Window.unboundedPreceding, 0)
    best = F.max_by(F.struct(order.alias("o"), F.col("_r").alias("r")), order)
    seen = both.withColumn("_up", best.over(up)).withColumn("_down", best.over(down)).where(F.col("_q") > 0)
    found = seen.select(*keys, F.col("_s").alias("_pseq"), F.when(F.col("_q") == 1, F.col("_up")).otherwise(F.col("_down")).alias("_b"))
    best = found.where(F.col("_b").isNotNull()).groupBy(*keys, "_pseq").agg(F.max_by("_b.r", "_b.o").alias("_top"))
    tops = best.select(*keys, F.col("_pseq").alias(seq), *[F.col(f"_top.{c}").alias(prefix + c) for c in fields])
    return null_safe_join(points, tops, [*keys, seq]) if full_rows else tops
