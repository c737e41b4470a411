"""Mixing sources to target weights by weighted fair queueing.

Every document waits in its source's queue, in a shuffled order (md5 of its
id and text), and gets a virtual finish time: the source's words up to and including it
divided by the source's target.  The queue is gone through again for the second
copy of its documents.  All queues together, in order of finish time, are
taken until the total budget is used up.

Both running sums are cut into blocks (of the shuffled order per source, of
virtual time over all), so a source that holds most rows is many groups: block
totals are map-side combined aggregates, running sums over the totals give each
block its offset, and a window inside the block does the rest.  Only ids and
sizes are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .store import written

WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
ROWS_PER_BLOCK = 4096


def text_size(text: str | Column) -> Column:
    """Number of words (``[^\\x20\\x09-\\x0D]+``) of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)``: the sources share ``share`` of all
    sizes by their weights, no target above ``repeats`` times its source.

    Filling in order of ``cap / weight``: a source is capped when its cap is at
    most its share of what the sources before it leave.  One row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (nth % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * repeats).alias("cap"))
    fill = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every).cast("double") * share - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double")
    per = per.withColumn("level", left / F.sum("weight").over(after).cast("double"))
    per = per.withColumn("capped", F.col("cap").cast("double") <= F.col("weight") * F.col("level"))
    # The sources after the last capped one share what is left at one level.
    level = F.max_by("level", F.when(~F.col("capped"), -F.col("cap").cast("double") / F.col("weight"))).over(every)
    return per.select("source", "source_size",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
                rows_per_block: int | None = None) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs(doc_id, source, text)``.

    ``taken`` is the words the mix takes of the row, copies counted (0 to
    ``repeats`` times ``size``).  Null texts, empty ones and such without words
    have size 0 and nothing taken; a null source is a source of its own, the
    last; rows with a null id, and repeated rows, queue like others (equal
    rows in any order, with the same result).  An empty table gives no rows.
    """
    spark = docs.sparkSession
    apply_recommended_conf(spark)
    # The text is in the turn too: rows of a null or repeated id do not share a place.
    text = F.col("text").cast("string").cast("binary")
    turn = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(text))
    sized = written(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), text_size("text").alias("size"),
                                F.md5(turn.cast("binary")).alias("turn")), "sizes")
    targets = source_targets(sized, weights, share, repeats)
    blocks = max(1, min(1 << 28, sized.count() // (rows_per_block or ROWS_PER_BLOCK)))

    queue = sized.withColumn("blk", F.floor(F.conv(F.substring("turn", 1, 7), 16, 10).cast("double") / (1 << 28) * blocks).cast("long"))
    totals = queue.groupBy("source", "blk").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "blk", F.coalesce(F.sum("words").over(so_far), F.lit(0)).alias("before"))
    offsets = offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(offsets["source"], "blk", "before", "source_size", "target")
    inside = Window.partitionBy("source", "blk").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = queue.withColumn("upto", F.sum("size").over(inside))
    o = offsets.withColumnsRenamed({"source": "o_source", "blk": "o_blk"})
    queue = (queue.join(o, queue["source"].eqNullSafe(o["o_source"]) & (queue["blk"] == o["o_blk"]))
             .select("doc_id", "source", "turn", "size", "source_size", "target", (F.col("before") + F.col("upto")).alias("upto")))

    lap = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("lap")
    finish = (F.col("lap") * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")
    line = queue.select("*", lap).withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0)))
    # Late virtual times thin out as queues end: on a log scale their blocks stay as even.
    even = F.when(F.col("finish") <= 1, F.col("finish")).otherwise(1 + F.log(F.greatest("finish", F.lit(1.0))))
    line = line.withColumn("span", F.floor(even * blocks).cast("long"))
    order = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = line.groupBy("span").agg(F.sum("size").alias("words")).select(
        F.col("span").alias("s_span"), F.coalesce(F.sum("words").over(order), F.lit(0)).alias("start"),
        (F.sum("words").over(Window.partitionBy()) / repeats * share).alias("budget"))
    at = (Window.partitionBy("span").orderBy("finish", F.col("source").asc_nulls_last(), "turn", "doc_id", "size", "lap")
          .rowsBetween(Window.unboundedPreceding, 0))
    line = line.withColumn("run", F.sum("size").over(at)).join(spans, F.col("span") == F.col("s_span"))
    took = F.when((F.col("start") + F.col("run")).cast("double") <= F.col("budget"), F.col("size")).otherwise(F.lit(0).cast("long"))
    # A row with words has its queue place to itself; equal rows without words
    # share one and are dealt out again.
    same = line.groupBy("doc_id", "source", "turn", "upto", "size", "source_size", "target").agg(F.sum(took).alias("taken"), F.count("*").alias("n"))
    copies = F.explode(F.sequence(F.lit(1), (F.col("n") / repeats).cast("int"))).alias("copy")
    return same.select("doc_id", "size", "source_size", "target", "taken", copies).drop("copy")
