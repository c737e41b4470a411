"""Global windows: any trigger with any evictor.

One never-ending window per key holds the records in their order of arrival.  A
trigger says at which records it fires; at a fire, an evictor says which of the
records that have arrived are its content:

* ``Count(n)`` as trigger fires at every ``n``-th record of a key, as evictor keeps
  the last ``n``;
* ``Delta(measure, threshold, kind)`` fires as in ``delta_any``;
* ``Span(ts, span_us)`` keeps the records later than the largest ``ts`` so far less
  the span (a record exactly that old is out).  What is evicted stays out, but
  the largest time never falls, so no later fire would want it.

Both contents are ranges of one number -- the ordinal, or the event time -- that
end at a value known for each fire, so the fires can meet the records in one join on
``(key, bucket of the range's length)``: a fire looks into two buckets, and a hot
key is spread over its buckets.  Ordinal and running maximum come from the
blocked running totals; no task holds a key.

For a ``Span`` that join is fires x records per span.  Aggregates that can be
merged, given as ``(kind, column)``, come from :func:`_span_folds` instead, whose
work is linear but for a factor of the levels (the bits of a span).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .count_window import ORDINAL
from .delta_any import change_fires
from .prefix import MIN_ROWS_PER_BLOCK, null_safe_join
from .rolling import rolling_sums


@dataclass(frozen=True)
class Count:
    n: int


@dataclass(frozen=True)
class Delta:
    measure: str
    threshold: float
    kind: str = "difference"


@dataclass(frozen=True)
class Span:
    ts: str
    span_us: int


def global_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], trigger: Count | Delta, evictor: Count | Span,
                  aggs: Mapping[str, Column | tuple], block_on: str | Column | None = None, n_blocks: int | None = None,
                  min_rows_per_block: int = MIN_ROWS_PER_BLOCK) -> DataFrame:
    """``(keys..., order..., seq_in_key, aggs...)``, one row per fire.

    ``order`` (total per key) is the order of arrival; ``aggs`` are aggregates over
    the content's columns, among them ``seq_in_key``, the ordinal of a record in its
    key; or ``("count" | "sum" | "min" | "max", column)`` and ``("max_by", column,
    order)``, which for a ``Span`` scale whatever it holds (if all are of this form).
    A record with a NULL time is never content of a ``Span``.  ``block_on``
    (monotone in ``order``) and ``n_blocks`` as in ``rolling_sum``.
    """
    keys, order = list(keys), list(order)
    width = evictor.n if isinstance(evictor, Count) else evictor.span_us
    if width < 1 or (isinstance(trigger, Count) and trigger.n < 1):
        raise ValueError("counts and spans must be positive")
    measures = {ORDINAL: F.lit(1).cast("long")}
    if isinstance(evictor, Span):
        src = df.withColumn("_at", F.unix_micros(F.col(evictor.ts).cast("timestamp")))
        measures["_end"] = ("max", F.col("_at"))
    else:
        src = df
    # read by the trigger, the fires and the content
    rows = materialize(rolling_sums(src, keys, order, measures, block_on, n_blocks, None, min_rows_per_block))
    if isinstance(evictor, Count):
        rows = rows.withColumn("_at", F.col(ORDINAL)).withColumn("_end", F.col(ORDINAL))

    fires = rows
    if isinstance(trigger, Count):
        fires = rows.where(F.col(ORDINAL) % trigger.n == 0)
    else:
        hits = change_fires(rows, keys, [ORDINAL], trigger.measure, trigger.threshold, trigger.kind, None, n_blocks, min_rows_per_block)
        fires = null_safe_join(rows, hits.select(*keys, ORDINAL), [*keys, ORDINAL], "inner")

    if isinstance(evictor, Span) and all(isinstance(a, tuple) for a in aggs.values()):
        return _span_folds(rows, fires, keys, order, width, aggs)
    aggs = {n: _FOLD[a[0]](*a[1:]) if isinstance(a, tuple) else a for n, a in aggs.items()}

    def bucket(c: str) -> Column:
        return F.floor(F.col(c) / F.lit(width)).cast("long")

    points = fires.select(*keys, *[F.col(c).alias(f"_f_{c}") for c in order], F.col(ORDINAL).alias("_fire"), F.col("_end").alias("_to"),
                          F.explode(F.array(bucket("_end"), bucket("_end") - 1)).alias("_b"))
    content = rows.drop("_end").withColumn("_b", bucket("_at"))
    both = null_safe_join(content, points, [*keys, "_b"])
    both = both.where((F.col("_at") > F.col("_to") - F.lit(width)) & (F.col("_at") <= F.col("_to")) & (F.col(ORDINAL) <= F.col("_fire")))
    out = both.groupBy(*keys, *[f"_f_{c}" for c in order], "_fire").agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*keys, *[F.col(f"_f_{c}").alias(c) for c in order], F.col("_fire").alias(ORDINAL), *aggs.keys())


_FOLD = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "max_by": F.max_by}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
FEW_NODES = 10_000            # levels with fewer records are asked only where they have some
_EPOCH = 1 << 60              # keeps all times above zero


def _span_folds(rows: DataFrame, fires: DataFrame, keys: Sequence[str], order: Sequence[str], width: int,
                aggs: Mapping[str, tuple]) -> DataFrame:
    """The content of a ``Span`` at each fire, folded without pairs of fire and record.

    A record is content while the largest time ``m`` is in ``[m at its arrival, its
    time + width)``.  Of the blocks of time of 1, 2, 4, ... microseconds one is the
    largest whose end parts that interval: there the record is kept, once.  At
    fires in the block it ends it is content from its arrival on -- a running fold in
    order of arrival -- and in the block after until its interval ends: a running
    fold from the latest end on.  A fire asks every level once, and only where
    the parting time is within ``width``.
    """
    end = F.col("_end") + F.lit(_EPOCH)
    values = F.struct(*[F.struct(*[c.alias(f"c{i}") for i, c in enumerate(a[1:])]).alias(n) for n, a in aggs.items()])
    recs = rows.select(*keys, F.col(ORDINAL).alias("_rn"), end.alias("_m"), (F.col("_at") + F.lit(_EPOCH + width)).alias("_y"), values.alias("_v"))
    recs = recs.where(F.col("_y") > F.col("_m")).withColumn("_k", (F.length(F.bin(F.col("_m").bitwiseXOR(F.col("_y")))) - 1).cast("int"))
    recs = recs.select(*keys, "_k", F.expr("shiftright(_m, _k + 1)").alias("_node"), "_rn", "_y", F.lit(0).alias("_q"), "_v")

    points = fires.where(F.col("_end").isNotNull()).select(*keys, *[F.col(c).alias(f"_f_{c}") for c in order], F.col(ORDINAL).alias("_rn"), end.alias("_y"))

    def ask(levels: list[int]) -> DataFrame:
        asks = points.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
        asks = asks.withColumn("_node", F.expr("shiftright(_y, _k + 1)")).withColumn("_q", F.expr("1 + cast(shiftright(_y, _k) % 2 as int)"))
        apart = F.expr("shiftleft(2 * _node + 1, _k)")
        return asks.where(F.abs(apart - F.col("_y")) <= F.lit(width))

    counts = {r["_k"]: r["count"] for r in recs.groupBy("_k").count().collect()}     # one number per level
    few = sorted(k for k, n in counts.items() if n <= FEW_NODES)
    asks = ask(sorted(counts.keys() - set(few)))
    if few:
        nodes = recs.where(F.col("_k").isin(few)).select(*keys, "_k", "_node").distinct()
        asks = asks.unionByName(null_safe_join(ask(few), nodes, [*keys, "_k", "_node"], "left_semi"))

    w = Window.partitionBy(*keys, "_k", "_node")
    up = w.orderBy("_rn", "_q").rowsBetween(Window.unboundedPreceding, 0)
    # a record that ends at the fire's time is no longer content
    down = w.orderBy(F.desc("_y"), F.desc("_q")).rowsBetween(Window.unboundedPreceding, 0)
    is_rec = F.col("_q") == 0

    def fold(name: str, kind: str) -> Column:
        c = [F.when(is_rec, F.col(f"_v.{name}.c{i}")) for i in range(len(aggs[name]) - 1)]
        if kind == "max_by":          # with its rank, to be merged
            return F.max_by(F.struct(c[1].alias("o"), c[0].alias("r")), c[1])
        return _FOLD[kind](*c)

    both = recs.unionByName(asks, allowMissingColumns=True)
    folds = {"_n": F.count(F.when(is_rec, 1)), **{f"_a_{n}": fold(n, a[0]) for n, a in aggs.items()}}
    seen = both.select("*", F.struct(*[c.over(up).alias(n) for n, c in folds.items()]).alias("_up"),
                       F.struct(*[c.over(down).alias(n) for n, c in folds.items()]).alias("_down")).where(~is_rec)
    parts = seen.select(*keys, *[f"_f_{c}" for c in order], "_rn", F.when(F.col("_q") == 1, F.col("_up")).otherwise(F.col("_down")).alias("_p"))
    parts = parts.where("_p._n > 0")
    merged = [F.max_by(f"_p._a_{n}.r", f"_p._a_{n}.o") if a[0] == "max_by" else _MERGE[a[0]](f"_p._a_{n}") for n, a in aggs.items()]
    types = {f.name: f.dataType for f in parts.select("_p.*").schema.fields}
    out = parts.groupBy(*keys, *[f"_f_{c}" for c in order], "_rn").agg(
        *[(m if a[0] == "max_by" else m.cast(types[f"_a_{n}"])).alias(n) for m, (n, a) in zip(merged, aggs.items())])
    return out.select(*keys, *[F.col(f"_f_{c}").alias(c) for c in order], F.col("_rn").alias(ORDINAL), *aggs.keys())
