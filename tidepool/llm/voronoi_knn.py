"""Exact top-k inner-product search as a Voronoi kNN join.

Vectors belong to the cell of their nearest pivot and lie, in order of cell and
distance to the pivot, in blocks of bounded size.  A cell's summary holds the
smallest distances of its members to the pivot; for a query ``q`` and a member
at distance ``d`` of pivot ``p``, ``q.p - |q| d <= q.x <= q.p + |q| d``.  The
lower bounds from the summaries, and the query's scores in the one block that
holds its own vector, give a score that its k-th best surely reaches.  A block
is paired with a block of queries only if the upper bound of one of its cells
reaches that score for one of them, and of such a cell only the members whose
own bound does are sent.  The local results are merged by rank.

Equal vectors count once with their ``k + 1`` smallest ids (all that a result
can name), picked before the shuffle, so a vector that fills a third of the
table is one row.  Pivots (the square root of the rows, at most
``MOST_PIVOTS``), their summaries (``k + 1`` numbers each) and at most ``k + 1``
ids for zero queries are the only data that every task sees.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .order import ranked
from .packed import matrix, packed
from .store import written

MOST_PIVOTS = 1024
QUERY_BLOCK, DATA_BLOCK = 512, 4096
#: Of a scaled component; scores then fit 64 bits.
LARGEST = 2.0**24
SLICE = 256                  # queries whose bounds are worked out at a time
RESULT = "pos long, query_id long, vec_id long, score long"
NEVER = np.iinfo(np.int64).min


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _cells(shared, d: int):
    """The cell of every vector and an upper bound of its distance to the pivot."""
    def run(batches):
        pivots, norm = shared.value
        for b in batches:
            x = matrix(b.column(1), "<i4", d).astype(np.float64)
            square = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ pivots.T + norm, 0)
            cell = square.argmin(axis=1)
            dist = np.sqrt(square[np.arange(len(x)), cell]) + 1e-6 + 1e-7 * _norms(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(dist, pa.float64())], names=[*b.schema.names, "cell", "dist"])

    return run


def _bounds(shared, d: int, k: int):
    """Per query block and cell: the smallest distance to the pivot that matters."""
    def least(q: np.ndarray, known: np.ndarray) -> np.ndarray:
        pivots, near = shared.value
        norm, dot = _norms(q)[:, None], q @ pivots.T
        low = (dot[:, :, None] - norm[:, :, None] * near[None]).reshape(len(q), -1)
        # k + 1: the query itself may be among the members counted.
        at = low.shape[1] - k - 1
        sure = np.partition(low, at, axis=1)[:, at] if at >= 0 else np.full(len(q), -np.inf)
        r = (np.maximum(sure, known)[:, None] - dot) / norm
        return r - 1e-6 * (1 + np.abs(np.where(np.isfinite(r), r, 0))) - 1e-9 * _norms(pivots).max()

    def run(batches):
        for b in batches:
            blk = b.column(0).to_numpy(zero_copy_only=False)
            q, known = matrix(b.column(1), "<i4", d).astype(np.float64), b.column(2).to_numpy(zero_copy_only=False)
            r = [least(q[i : i + SLICE], known[i : i + SLICE]) for i in range(0, len(q), SLICE)]
            for v in np.unique(blk):
                m = np.min([s[hit].min(axis=0) for i, s in enumerate(r) if (hit := blk[i * SLICE : (i + 1) * SLICE] == v).any()], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), v), pa.int64()), pa.array(np.arange(len(m)), pa.int32()), pa.array(m, pa.float64())], names=["qb", "cell", "least"])

    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows.

    ``|q| |x|`` bounds every partial sum; below 2**53 doubles hold them all."""
    a, b = q.astype(np.float64), x.astype(np.float64)
    if len(a) and len(b) and _norms(a).max() * _norms(b).max() >= 2.0**52:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return (a @ b.T).astype(np.int64)


def _solve(k: int, d: int):
    """The ``k`` best of a block's vectors for every query, itself left out."""
    def run(queries, data):
        import pandas as pd

        out = []
        if len(queries) and len(data):
            ids = data.vec_id.to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            score = products(matrix(queries.vec, "<i4", d), matrix(data.vec, "<i4", d)[order])
            for pos, q, row in zip(queries.pos, queries.query_id, score, strict=True):
                row[ids == q] = NEVER
                n = min(k, int((ids != q).sum()))
                if not n:
                    continue
                cut = np.partition(row, len(row) - n)[len(row) - n]
                hit = np.flatnonzero(row >= cut)
                hit = hit[np.lexsort((ids[hit], -row[hit]))][:n]
                out.append(pd.DataFrame({"pos": pos, "query_id": q, "vec_id": ids[hit], "score": row[hit]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("pos", "query_id", "vec_id", "score")}, dtype="int64")

    return run


def _solved(queries: DataFrame, data: DataFrame, k: int, d: int) -> DataFrame:
    data = data.select(F.col("qb").alias("for_qb"), F.col("block").alias("of_block"), "vec_id", "vec")
    asked = queries.select(F.col("qb").alias("in_qb"), F.col("block").alias("at_block"), "pos", "query_id", "vec")
    return asked.groupBy("in_qb", "at_block").cogroup(data.groupBy("for_qb", "of_block")).applyInPandas(_solve(k, d), RESULT)


def routes(queries: DataFrame, data: DataFrame, shared, d: int, k: int) -> DataFrame:
    """``(qb, block, cell, least)``: what of which block a block of queries needs.

    ``queries`` are ``(pos, query_id, vec, qb, block)`` with the block that holds
    the query's own vector, ``data`` are ``(vec_id, vec, cell, dist, block)``.
    """
    own = queries.select("qb", "block").distinct().join(data.select("block", "vec_id", "vec"), "block")
    known = _solved(queries, own, k, d).groupBy("pos").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    known = known.filter(F.col("n") == k).select("pos", F.col("kth").cast("double").alias("kth"))
    bounded = queries.join(known, "pos", "left").select("qb", "vec", F.coalesce("kth", F.lit(float("-inf"))).alias("kth"))
    least = bounded.mapInArrow(_bounds(shared, d, k), "qb long, cell int, least double").groupBy("qb", "cell").agg(F.min("least").alias("least"))
    far = data.groupBy("block", "cell").agg(F.max("dist").alias("far"))
    return written(far.join(least, "cell").filter(F.col("far") >= F.col("least")).select("qb", "block", "cell", "least"), "routes")


def _zero_queries(every: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """All scores of a zero query are 0: the smallest other ids are its result."""
    first = every.groupBy("vec_id").agg(F.count("*").alias("n")).orderBy("vec_id").limit(k + 1).collect()
    ids = F.array(*[F.lit(r["vec_id"]).cast("long") for r in first for _ in range(min(k, r["n"]))])
    others = F.slice(F.filter(ids, lambda i: i != F.col("query_id")), 1, k)
    return queries.select("query_id", F.explode(others).alias("vec_id"), F.lit(0).cast("long").alias("score"))


def top_k(table: DataFrame, is_query: Callable[[Column], Column], k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vec_col: str = "embedding", pivots: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest integer inner
    products with all other rows, ties to the smaller ``vec_id``.

    ``is_query(id column)`` tells the query rows.  Fewer other rows than ``k``
    give them all; one row alone, and an empty table, give none.  Rows that
    repeat an id and vector count once.  Other columns are ignored.  Rows with a
    null id or vector, a null or non-finite component or an empty vector take no
    part, nor do vectors of another length than the commonest (of equally common
    ones the longest) and such with a scaled component of 2**24 or more, whose
    scores might not fit a long.
    """
    spark = table.sparkSession
    apply_recommended_conf(spark)
    vectors, d, _ = packed(table, id_col, vec_col, scale=scale, largest=LARGEST)
    every = written(vectors.distinct(), "vectors")
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    data = every.withColumn("nth", nth).filter(F.col("nth") <= k + 1).drop("nth")
    pivots = pivots or max(1, min(MOST_PIVOTS, math.isqrt(every.count())))
    picked = every.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(pivots).collect()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    p = matrix([r["vec"] for r in picked], "<i4", d).astype(np.float64)
    cells = spark.sparkContext.broadcast((p, (p * p).sum(axis=1)[None]))
    data = data.mapInArrow(_cells(cells, d), "vec_id long, vec binary, cell int, dist double")
    data = ranked(data, [F.col(c) for c in ("cell", "dist", "vec_id", "vec")], "place", "cells")
    data = written(data.select("vec_id", "vec", "cell", "dist", F.floor(F.col("place") / DATA_BLOCK).cast("long").alias("block")), "blocks")
    near = np.full((len(p), k + 1), np.inf)
    closest = F.row_number().over(Window.partitionBy("cell").orderBy("dist", "vec_id"))
    for r in data.select("cell", "dist", closest.alias("nth")).filter(F.col("nth") <= k + 1).collect():
        near[r["cell"], r["nth"] - 1] = r["dist"]
    summary = spark.sparkContext.broadcast((p, near))

    queries = every.filter(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "query_id")
    zero = F.col("vec") == F.lit(bytes(4 * d))
    home = data.groupBy("vec").agg(F.min("block").alias("block"))
    placed = ranked(queries.filter(~zero).join(home, "vec"), [F.col(c) for c in ("block", "query_id", "vec")], "pos", "queries")
    placed = written(placed.select("pos", "query_id", "vec", F.floor(F.col("pos") / QUERY_BLOCK).cast("long").alias("qb"), "block"), "query-blocks")
    route = routes(placed, data, summary, d, k)

    sent = data.join(route, ["block", "cell"]).filter(F.col("dist") >= F.col("least")).select("qb", "block", "vec_id", "vec")
    asked = placed.drop("block").join(route.select("qb", "block").distinct(), "qb")
    local = _solved(asked, sent, k, d).drop("pos").unionByName(_zero_queries(every, queries.filter(zero), k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
