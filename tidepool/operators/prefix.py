"""Skew-safe per-key running totals ("blocked prefix sums").

A running total per key in a given order is normally a window function
``partitionBy(key).orderBy(order)``, which sends *all* rows of a key to one
task.  When one key holds a large share of the data (a frequent word, one of
eight cars) that task is the whole job.

Here the order axis is cut into ``n_blocks`` monotone blocks, at quantiles
of the order value:

1. local running totals per ``(key, block)`` -- one hash exchange on
   ``(key, block)``, so a hot key is spread over many tasks;
2. per ``(key, block)`` totals by partial aggregation of the input (a
   second, narrow scan and a small exchange -- cheaper than re-reading the
   rows' shuffle, which a flat-map makes much larger than the input);
3. exclusive prefix of the block totals per key -- a window over at most
   ``n_blocks`` rows per key;
4. the offset is joined back on ``(key, block)``; the row side is already
   partitioned on those columns, so only the small offsets side moves.

Only heavy keys are cut (:func:`heavy_keys`): a key that is small against a
task's share of the rows stays whole, and where no key is heavy the plan is one
plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_blk"


def default_blocks(df: DataFrame) -> int:
    """Blocks per key: a few per shuffle partition, so one key's rows can
    cover every task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, 4 * parts)


MIN_ROWS_PER_BLOCK = 2_000
MAX_ROWS_PER_BLOCK = 2_000_000
MAX_BLOCKS = 20_000               # the edges are one literal of this plan
TREE_EDGES = 256                  # so many are compared in generated code
HEAVY_ROWS = 1_000                # a key below this is never heavy


def heavy_keys(df: DataFrame, keys: Sequence[str], least: int = HEAVY_ROWS) -> tuple[DataFrame | None, bool]:
    """The keys that hold more than half of an even task's share of the rows
    (and ``least``), and whether any other key exists.

    One combined count; at most two keys per shuffle partition can qualify, so
    the list is small whatever the table.  ``None`` when no key is heavy."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    seen = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(
        seen, F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys"))
    top = counts.orderBy(F.desc("_n")).limit(2 * parts).collect()
    rows, n_keys = seen.get["rows"] or 0, seen.get["keys"]
    heavy = [tuple(r)[:-1] for r in top if r["_n"] > max(least, rows / (2 * parts))]
    if not heavy:
        return None, True
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
    return df.sparkSession.createDataFrame(heavy, schema), len(heavy) < n_keys


def mark_heavy(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """``df`` with a flag ``_heavy``; the bounded list is broadcast."""
    right = heavy.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_hit"))
    same = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_h_{k}"))
        same = e if same is None else same & e
    return df.join(F.broadcast(right), same, "left").select(*df.columns, F.coalesce("_hit", F.lit(False)).alias("_heavy"))


def _below(value: Column, edges: Sequence[Column], lo: int, hi: int) -> Column:
    """The number of ``edges`` below ``value``, as a balanced tree of tests."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(edges[mid] < value, _below(value, edges, mid + 1, hi)).otherwise(_below(value, edges, lo, mid))


def range_block(df: DataFrame, value: Column, n_blocks: int,
                min_rows_per_block: int = MIN_ROWS_PER_BLOCK, max_rows_per_block: int = MAX_ROWS_PER_BLOCK) -> Column:
    """A block index that is monotone in ``value`` (numeric): its observed
    quantiles cut the rows of ``df`` into ``n_blocks`` blocks of about equal
    size, wherever the values lie -- fewer, so that a block averages at least
    ``min_rows_per_block`` rows; more, so that it averages at most
    ``max_rows_per_block`` (up to ``MAX_BLOCKS`` blocks).  The driver
    receives the edges, at most one scalar per block."""
    def quantiles(count: int) -> DataFrame:
        parts = [i / count for i in range(1, count + 1)]
        return df.select(F.count(value).alias("n"),
                         F.approx_percentile(value, parts, max(1_000, 10 * count)).alias("edges"))

    at = quantiles(n_blocks)
    n, found = at.first()
    if not n:
        return F.lit(0).cast("long")
    wanted = min(max(1, min(n_blocks, n // max(1, min_rows_per_block)), -(-n // max_rows_per_block)), MAX_BLOCKS)
    if wanted == 1:
        return F.lit(0).cast("long")
    if wanted > n_blocks:
        found = quantiles(wanted).first()["edges"]
    # the upper edges of all blocks but the last
    edges = sorted({found[i * len(found) // wanted - 1] for i in range(1, wanted)})
    kind = at.schema["edges"].dataType
    if len(edges) <= TREE_EDGES:
        literals = [F.lit(e).cast(kind.elementType) for e in edges]
        below = _below(value, literals, 0, len(edges))
    else:
        # by binary search in one literal array: a tree of so many tests would not compile
        array = F.split(F.lit(",".join(map(str, edges))), ",").cast(kind.simpleString())
        steps = F.array(*[F.lit(2 ** k) for k in reversed(range(len(edges).bit_length()))])
        below = F.aggregate(steps, F.lit(0), lambda pos, step: F.when(
            F.get(array, pos + step - 1) < value, pos + step).otherwise(pos))
    # NULLs sort first, so they belong to the first block.
    return F.when(value.isNull(), F.lit(0)).otherwise(below).cast("long")


KEY = "_key"


def key_struct(keys: Sequence[str]) -> Column:
    """All key columns as one struct.  Struct equality treats NULL fields as
    equal, so a plain equi-join on it is NULL-safe *and* keeps the
    ``hashpartitioning(_key, ...)`` of an earlier exchange (a ``<=>`` join
    would be planned on ``coalesce``/``isnull`` expressions and re-shuffle)."""
    return F.struct(*[F.col(k) for k in keys])


def partition_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], bool]:
    """Columns to partition, group and join on for ``keys``: the keys
    themselves when none is nullable (fast sorts and hashes), otherwise one
    :func:`key_struct` column.  Returns ``(df, columns, wrapped)``."""
    if not any(df.schema[k].nullable for k in keys):
        return df, list(keys), False
    return df.withColumn(KEY, key_struct(keys)), [KEY], True


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` treating NULL keys as equal values; the right
    copies of ``cols`` are dropped.  Non-nullable keys use a plain join."""
    if not any(left.schema[c].nullable or right.schema[c].nullable for c in cols):
        return left.join(right, list(cols), how).select(*left.columns,
                                                        *[c for c in right.columns if c not in cols])
    l, r = left.alias("_l"), right.alias("_r")
    cond = None
    for c in cols:
        e = F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))
        cond = e if cond is None else cond & e
    joined = l.join(r, cond, how)
    keep = [F.col(f"_l.{c}") for c in left.columns] + [F.col(f"_r.{c}") for c in right.columns if c not in cols]
    return joined.select(*keep)


def _measures(measures: Mapping[str, Column | tuple[str, Column]]) -> dict[str, tuple[str, Column]]:
    return {n: m if isinstance(m, tuple) else ("sum", m) for n, m in measures.items()}


_FOLD = {"sum": F.sum, "max": F.max}


def _merge(kind: str, a: Column, b: Column) -> Column:
    """Of two parts, either NULL while it has seen no value."""
    return F.greatest(a, b) if kind == "max" else F.coalesce(a + b, a, b)


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   measures: Mapping[str, Column | tuple[str, Column]], exclusive: bool = False) -> DataFrame:
    """:func:`blocked_running_totals` by one plain window, for keys of which none is heavy."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return df.select("*", *[_FOLD[kind](m).over(w).alias(n) for n, (kind, m) in _measures(measures).items()])


def blocked_running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    block: Column,
    measures: Mapping[str, Column | tuple[str, Column]],
    start: DataFrame | None = None,
    heavy: DataFrame | None = None,
    exclusive: bool = False,
) -> DataFrame:
    """Add inclusive (``exclusive``: without the record itself) running totals ``measures`` (name → numeric column, or
    ``("max", column)`` for a running maximum) per
    ``keys`` in ``order``.  ``block`` must be monotone in ``order`` (e.g.
    :func:`range_block` of the leading order column).  Keeps the ``_blk``
    column.  ``start`` (keys and measures, one row per key) holds totals to
    begin with; it meets the block totals, not the rows.  With ``heavy``
    (:func:`heavy_keys`) only those keys are cut; any other lies whole in
    block 0 and needs no offset."""
    keys, kinds = list(keys), {n: kind for n, (kind, _) in _measures(measures).items()}
    base = df
    for name, (_, m) in _measures(measures).items():
        base = base.withColumn(f"_m_{name}", m)
    if heavy is None:
        base = base.withColumn("_heavy", F.lit(True)).withColumn(BLOCK, block)
    else:
        base = mark_heavy(base, keys, heavy).withColumn(BLOCK, F.when(F.col("_heavy"), block).otherwise(F.lit(0).cast("long")))
    base, pk, wrapped = partition_keys(base, keys)
    if wrapped:                       # the struct is the only copy of the keys
        base = base.drop(*keys)
    w_local = (Window.partitionBy(*pk, BLOCK).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0))
    local = base.select("*", *[_FOLD[kinds[n]](f"_m_{n}").over(w_local).alias(f"_loc_{n}") for n in kinds])

    # Block totals are re-derived from the input: Catalyst drops the unused
    # window and aggregates partially before a tiny (key, block) exchange.
    # Re-reading the rows' shuffle instead would cost more at scale -- after
    # a flat-map (tokenising) the rows' exchange is far larger than the scan.
    cut = base if start is not None else base.where(F.col("_heavy"))
    totals = cut.groupBy(*pk, BLOCK).agg(*[_FOLD[kinds[n]](f"_m_{n}").alias(f"_tot_{n}") for n in kinds])
    w_blocks = Window.partitionBy(*pk).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *pk, BLOCK,
        *[_FOLD[kinds[n]](f"_tot_{n}").over(w_blocks).alias(f"_off_{n}") for n in kinds],
    )
    if start is not None:
        begin = start.select(*keys, *[F.col(n).alias(f"_beg_{n}") for n in kinds])
        if wrapped:
            begin = begin.withColumn(KEY, key_struct(keys)).drop(*keys)
        offsets = offsets.join(begin, pk, "left").select(
            *pk, BLOCK, *[_merge(kinds[n], F.col(f"_off_{n}"), F.col(f"_beg_{n}")).alias(f"_off_{n}") for n in kinds])
    joined = local.join(offsets, [*pk, BLOCK], "inner" if heavy is None else "left")
    # wrapped keys are read back from the struct (one copy travels)
    out_cols = [F.col(f"{KEY}.{c}").alias(c) if wrapped and c in keys else F.col(c) for c in df.columns]
    out_cols.append(F.col(BLOCK))
    return joined.select(
        *out_cols,
        *[_merge(kinds[n], F.col(f"_loc_{n}"), F.col(f"_off_{n}")).alias(n) for n in kinds],
    )


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  block: Column, name: str = "rn") -> DataFrame:
    """Per-key ordinal (1, 2, ...) in ``order``: ``row_number`` without
    sending a whole key to one task."""
    return blocked_running_totals(df, keys, order, block, {name: F.lit(1).cast("long")})
