"""Batch operators on a stream, with what a batch hands to the next one.

``foreachBatch`` functions for order-dependent operators: the rows that a key
needs from earlier batches (a total, a reference point, the last few records)
are a small table that each batch reads from its predecessor and writes anew.
They enter the batch as its first rows (``_new`` = 0), so the batch operators --
blocks, heavy keys and all -- run unchanged, and no Python runs per key.  Both
writes of a batch replace the folder of its own id, so a repeated batch gives
the same result.  Records must arrive in order from batch to batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.count_window import ORDINAL, window_differences
from ..operators.delta_any import change_fires
from ..operators.reduce import keyed_reduce, rolling_reduce, window_reduce
from ..operators.rolling import rolling_sums
from ..operators.trailing import trailing_max_at
from ..session import materialize

NEW = "_new"
Sink = Callable[[DataFrame, int], None]
#: ``step(rows, before)`` gives the batch's output and what the next one needs.
Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def carried(step: Step, state: str, sink: Sink) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function around ``step``, whose ``before`` has the rows of
    every key so far (None in the first batch)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()               # read by the counts, the edges and the plan
        try:
            before = batch.sparkSession.read.parquet(f"{state}/batch-{batch_id - 1}") if batch_id > 0 else None
            out, after = step(batch, before)
            sink(out, batch_id)
            after.write.mode("overwrite").parquet(f"{state}/batch-{batch_id}")
        finally:
            batch.unpersist()

    return write_batch


def _with_carried(rows: DataFrame, before: DataFrame | None) -> DataFrame:
    rows = rows.withColumn(NEW, F.lit(1))
    return rows if before is None else before.withColumn(NEW, F.lit(0)).unionByName(rows)


def _blocks(at: str | Column) -> Column:
    """Monotone in ``(_new, order)``: carried rows belong to the first block."""
    return F.when(F.col(NEW) == 1, F.col(at) if isinstance(at, str) else at)


def _first_of_key(key: str, order: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1


def count_value_batches(key: str, order: Sequence[str], value: Column, size: int, slide: int, state: str, sink: Sink,
                        name: str = "n", block_on: str | Column | None = None) -> Callable[[DataFrame, int], None]:
    """Sliding count windows that sum a value (integral or decimal): fires
    ``(key, order..., seq_in_key, name)``.  The last ``size`` values of a key are
    carried, with their ordinals."""
    order = list(order)
    at = _blocks(order[0] if block_on is None else block_on)

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        rows = rows.select(key, *order, value.alias("_val")).withColumn("_rn", F.lit(1).cast("long"))
        if before is not None:
            # carried rows are a key's last ones, so only the first tells its ordinal
            before = before.withColumn("_rn", F.when(_first_of_key(key, order), F.col("_rn")).otherwise(F.lit(1)))
        src = _with_carried(rows, before)
        sum_type = src.select(F.sum("_val").alias("s")).schema["s"].dataType
        ranked = materialize(rolling_sums(src, [key], [NEW, *order], {ORDINAL: F.col("_rn"), "_sum": F.col("_val"),
                                          "_some": F.col("_val").isNotNull().cast("long")}, at))
        fires = window_differences(ranked, [key], [NEW, *order], size, slide, name, sum_type).where(F.col(NEW) == 1)
        last = ranked.groupBy(F.col(key).alias("_k")).agg(F.max(ORDINAL).alias("_last"))
        tail = ranked.join(last, F.col(key).eqNullSafe(F.col("_k"))).where(F.col(ORDINAL) > F.col("_last") - size)
        return fires.drop(NEW), tail.select(key, *order, "_val", F.col(ORDINAL).alias("_rn"))

    return carried(step, state, sink)


def rolling_reduce_batches(key: str, order: Sequence[str], value: Column, combine: Callable[[Column, Column], Column],
                           state: str, sink: Sink, name: str = "value",
                           block_on: str | Column | None = None) -> Callable[[DataFrame, int], None]:
    """Every record with its key's values so far folded by ``combine(earlier,
    later)`` (associative): ``(batch columns..., name)``.  One folded value per
    key is carried."""
    order = list(order)
    at = _blocks(order[0] if block_on is None else block_on)

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        columns = rows.columns
        src = _with_carried(rows.withColumn("_val", value), None)
        if before is not None:
            src = src.unionByName(before.withColumn(NEW, F.lit(0)), allowMissingColumns=True)
        folded = materialize(rolling_reduce(src, [key], [NEW, *order], F.col("_val"), combine, name, at))
        after = folded.groupBy(key).agg(F.max_by(name, F.struct(NEW, *order)).alias("_val"))
        return folded.where(F.col(NEW) == 1).select(*columns, name), after

    return carried(step, state, sink)


def pane_reduce_batches(keys: Sequence[str], ts: str, pane_us: int, value: Column,
                        combine: Callable[[Column, Column], Column], sink: Sink,
                        name: str = "value") -> Callable[[DataFrame, int], None]:
    """Folds per key and pane of event time (``pane``), one table per batch: parts
    that :func:`merge_panes` folds into windows.  ``combine`` must be associative
    and commutative; nothing is carried."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        t = F.unix_micros(F.col(ts).cast("timestamp"))
        rows = batch.where(F.col(ts).isNotNull()).select(
            *keys, F.timestamp_micros(F.floor(t / F.lit(pane_us)).cast("long") * pane_us).alias("pane"), value.alias("_val"))
        sink(keyed_reduce(rows, [*keys, "pane"], F.col("_val"), combine, name), batch_id)

    return write_batch


def merge_panes(parts: DataFrame, keys: Sequence[str], size_us: int, slide_us: int,
                combine: Callable[[Column, Column], Column], name: str = "value") -> DataFrame:
    """Windows of the panes of all batches so far (pane width: a divisor of
    size and slide)."""
    return window_reduce(parts, keys, "pane", size_us, slide_us, F.col(name), combine, name)


def top_speed_batches(key: str, ts: str, seq: str, speed_centi: str, speed: str, threshold: int, span_us: int,
                      state: str, sink: Sink, fire_ts: bool = False) -> Callable[[DataFrame, int], None]:
    """Top speed per fire ``(key, fire_seq, top_seq, top_speed, top_dist_c, top_ts)``,
    with ``fire_ts`` also the time of the firing record.
    Carried: a key's records of the last span, its odometer with them, and
    the reference point of its trigger."""
    order = [ts, seq]

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        at = _blocks(F.unix_micros(F.col(ts).cast("timestamp")))
        rows = rows.select(key, *order, F.col(speed).alias("_speed"), F.col(speed_centi).cast("long").alias("_sc"))
        rows = rows.withColumn("_m", F.col("_sc")).withColumn("_ref", F.lit(None).cast("long"))
        if before is not None:
            # the first carried record brings the odometer up to itself
            before = before.withColumn("_m", F.when(_first_of_key(key, order), F.col("dist_c")).otherwise(F.col("_sc"))).drop("dist_c")
        odo = materialize(rolling_sums(_with_carried(rows, before), [key], [NEW, *order], {"dist_c": F.col("_m")}, at))
        new = odo.where(F.col(NEW) == 1)
        refs = odo.where(F.col(NEW) == 0).groupBy(key).agg(F.max("_ref").alias("dist_c"))
        refs = refs.withColumn(NEW, F.lit(0)).withColumn(ts, F.lit(None).cast(odo.schema[ts].dataType)).withColumn(
            seq, F.lit(None).cast(odo.schema[seq].dataType))
        points = new.select(key, NEW, *order, "dist_c").unionByName(refs)
        fires = materialize(change_fires(points, [key], [NEW, *order], "dist_c", threshold, "difference", at).where(F.col(NEW) == 1))
        tops = trailing_max_at(fires, odo.withColumnRenamed("_speed", "speed"), [key], ts, seq, span_us, "speed",
                               [seq, "speed", "dist_c", ts], full_rows=False)
        out = tops.select(key, F.col(seq).alias("fire_seq"), F.col(f"top_{seq}").alias("top_seq"), "top_speed", "top_dist_c",
                          F.col(f"top_{ts}").alias("top_ts"))
        if fire_ts:
            at_fire = fires.select(F.col(key).alias("_k"), F.col(seq).alias("_s"), F.col(ts).alias("fire_ts"))
            out = out.join(at_fire, F.col(key).eqNullSafe(F.col("_k")) & (F.col("fire_seq") == F.col("_s"))).drop("_k", "_s")
        # the last fire is the reference; before any, the first record of the key
        last = fires.groupBy(F.col(key).alias("_fk")).agg(F.max_by("dist_c", F.struct(*order)).alias("_fired"))
        ends = odo.groupBy(F.col(key).alias("_k")).agg(F.max(ts).alias("_latest"), F.max("_ref").alias("_old"),
                                                       F.min_by("dist_c", F.struct(NEW, *order)).alias("_opened"))
        ends = ends.join(last, F.col("_k").eqNullSafe(F.col("_fk")), "left").select(
            "_k", "_latest", F.coalesce("_fired", "_old", "_opened").alias("_reference"))
        near = F.unix_micros(F.col(ts).cast("timestamp")) > F.unix_micros(F.col("_latest").cast("timestamp")) - span_us
        tail = odo.join(ends, F.col(key).eqNullSafe(F.col("_k"))).where(near)
        return out, tail.select(key, *order, "_speed", "_sc", F.col("_reference").alias("_ref"), "dist_c")

    return carried(step, state, sink)
