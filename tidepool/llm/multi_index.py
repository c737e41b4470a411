"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: learned rotations (iterative quantisation on a
bounded sample), one sign per rotated axis.  Inner products order like angles
once every vector has one more component that brings it to the largest norm;
queries have zero there.  A code of ``BITS`` bits is cut into 16-bit substrings and
each substring is an index of its own: the entries ``(substring number, value,
code)`` of all vectors in order of value, cut into blocks of bounded size.

Codes within Hamming distance ``r`` agree, in at least one substring ``j``, up to
``t_j`` bits, where the ``t_j + 1`` add up to ``r + 1``: a query visits the blocks
whose values share a prefix near its own, probes the values within ``t_j`` bits,
and keeps the codes within ``r`` -- all of them.  Their vectors are then
scored as they are, block by block of the vector table.

A first round with a small radius gives each query a score that its ``k`` best
surely reach; the second takes the radius within which, on the sample, a share
``KEPT`` of the pairs of that nearness lie, and only looks for better ones.
Candidates travel as packed positions, never as a row each, and there is no
cap on them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .order import ranked
from .packed import as_bytes, matrix, packed
from .store import written

BITS = 128                   # of a code; a multiple of 16
SAMPLE = 4096                # rows that rotations and radii are learned from
PAIRS = 1024                 # of them taken as queries
KEPT = 0.95                  # share of pairs of a nearness within its radius
FIRST = 10                   # codes per wanted neighbour that the first round looks for
ENTRIES = 16_384             # index entries, and vectors, of a block
MAX_BLOCKS = 1_000_000       # of the index; beyond, blocks grow
QUERY_BLOCK = 4096


class Codes:
    """Rotations and the radius of a nearness, learned from sample rows."""

    def __init__(self, x: np.ndarray, largest: float, bits: int, wanted: float):
        rng = np.random.default_rng(7)
        self.largest, self.bits = largest, bits
        y = self.lift(x)
        self.mean = y.mean(axis=0)
        centred = y - self.mean
        axes = np.linalg.svd(centred, full_matrices=True)[2][: min(bits, y.shape[1])].T
        flat, turns = centred @ axes, []
        for _ in range(-(-bits // axes.shape[1])):
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(20):
                u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
                turn = (u @ v).T
            turns.append(axes @ turn)
        self.axes = np.concatenate(turns, axis=1)[:, :bits]
        self._radii(x, wanted)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64) / self.largest
        return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))])

    def aim(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return np.column_stack([q / np.sqrt((q * q).sum(axis=1))[:, None], np.zeros(len(q))])

    def bytes(self, y: np.ndarray) -> np.ndarray:
        return np.packbits((y - self.mean) @ self.axes > 0, axis=1)

    def _radii(self, x: np.ndarray, wanted: float) -> None:
        q, y = self.aim(x[:PAIRS]), self.lift(x)
        a, b = words(self.bytes(q)), words(self.bytes(y))
        apart = np.concatenate([np.bitwise_count(row ^ b).sum(axis=1)[None] for row in a]).astype(np.int32)
        other = ~np.eye(*apart.shape, dtype=bool)
        near, apart = (q @ y.T)[other], apart[other]
        self.first = int(np.quantile(apart, min(1, wanted))) if len(apart) and wanted < 1 else self.bits
        self.steps = np.linspace(-1, 1, 101)
        step = np.clip(np.searchsorted(self.steps, near, side="right") - 1, 0, 100)
        found = np.full(101, -1)
        for s in np.unique(step):
            if (here := apart[step == s]).size >= 50:
                found[s] = np.ceil(np.quantile(here, KEPT))
        # no nearer pair needs less than a farther one may
        found = np.maximum.accumulate(found[::-1])[::-1]
        known = np.flatnonzero(found >= 0)
        self.radius = np.where(found >= 0, found, found[known[-1]]) if len(known) else np.full(101, self.bits)
        self.radius[: known[0] if len(known) else 0] = self.bits

    def needed(self, score: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Radius for neighbours of at least ``score`` (-inf: every code)."""
        near = np.clip(score / (norm * self.largest), -1, 1)
        return np.where(np.isfinite(score), self.radius[np.searchsorted(self.steps, near, side="right") - 1], self.bits)


def words(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes).view(np.uint64) if codes.shape[1] % 8 == 0 else codes


def parts(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes).view(">u2").astype(np.uint16)


def allowed(radius: int, n: int) -> np.ndarray:
    """Bits that each of ``n`` substrings may differ by (-1: not probed)."""
    base, more = divmod(radius + 1, n)
    return np.array([base + (j < more) for j in range(n)]) - 1


def _coded(model, kind, d, aim):
    def run(batches):
        m = model.value
        for b in batches:
            x = matrix(b.column(1), kind, d)
            y = (m.aim(x) if aim else m.lift(x)) if len(x) else np.zeros((0, d + 1))
            c = m.bytes(y)
            yield pa.RecordBatch.from_arrays([*b.columns, as_bytes(c, len(x), c.shape[1])], names=[*b.schema.names, "code"])

    return run


def _entries(n):
    """Per vector and substring: number, value, code and place of the vector."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            code, place = b.column(0), np.asarray(b.column(1))
            p = parts(matrix(code, np.uint8, 2 * n))
            for j in range(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), j), pa.int32()), pa.array(p[:, j], pa.int32()), code, pa.array(place, pa.int64())], names=["j", "value", "code", "place"])

    return run


def _routes(directory, n):
    """The index blocks that a query has to visit."""
    def run(batches):
        block, j, low, high = directory.value
        cut = np.array([int(a ^ b).bit_length() for a, b in zip(low, high, strict=True)], np.uint16)
        head, number = (low >> cut).astype(np.uint16), np.unique(block)
        for b in batches:
            if not b.num_rows:
                continue
            p, hit = parts(matrix(b.column("code"), np.uint8, 2 * n)), []
            for row, radius in zip(p, np.asarray(b.column("radius")), strict=True):
                ok = np.bitwise_count((row[j] >> cut) ^ head).astype(int) <= allowed(radius, n)[j]
                hit.append(np.intersect1d(block[ok], number))
            at = np.repeat(np.arange(len(p)), [len(h) for h in hit])
            out = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hit), pa.int64()), *out.columns], names=["block", *b.schema.names])

    return run


def _probe(n, size):
    """Places of all codes within the radius, by block of the vector table."""
    masks = np.arange(1 << 16, dtype=np.uint16)
    weight = np.bitwise_count(masks)

    def run(queries, index):
        import pandas as pd

        out = []
        if len(queries) and len(index):
            index = index.sort_values(["j", "value", "place"], kind="stable")
            js, codes = index.j.to_numpy(), matrix(index.code, np.uint8, 2 * n)
            value, place = index.value.to_numpy().astype(np.uint16), index.place.to_numpy()
            whole, sub = words(codes), parts(codes)
            groups = []
            for j in np.unique(js):
                at = np.flatnonzero(js == j)
                v, first, count = np.unique(value[at], return_index=True, return_counts=True)
                groups.append((j, v, at[0] + first, count))
            asked = matrix(queries.code, np.uint8, 2 * n)
            for q, w, s, radius in zip(queries["query"], words(asked), parts(asked), queries.radius, strict=True):
                t, found = allowed(radius, n), []
                for j, v, first, count in groups:
                    if t[j] < 0:
                        continue
                    probes = masks[weight <= t[j]] ^ s[j] if t[j] < 3 else None
                    if probes is not None and len(probes) < len(v):
                        at = np.searchsorted(v, probes)
                        at = at[(at < len(v)) & (v[np.minimum(at, len(v) - 1)] == probes)]
                    else:
                        at = np.flatnonzero(np.bitwise_count(v ^ s[j]) <= t[j])
                    c = count[at]
                    rows = np.repeat(first[at] - np.concatenate([[0], np.cumsum(c)[:-1]]), c) + np.arange(c.sum()) if len(at) else np.zeros(0, int)
                    rows = rows[np.bitwise_count(whole[rows] ^ w).sum(axis=1) <= radius]
                    # a code that an earlier substring finds too counts there
                    early = (np.bitwise_count(sub[rows, :j] ^ s[:j]) <= t[:j]).any(axis=1)
                    found.append(place[rows[~early]])
                found = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
                home = found // size
                for h in np.unique(home):
                    out.append((q, h, (found[home == h] % size).astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["query", "home", "places"])

    return run


def _score(k, kind, d):
    """The best of a query's candidates in a block of vectors, by exact sums."""
    def run(queries, data):
        import pandas as pd

        out = []
        if len(queries) and len(data):
            x, ids, place = matrix(data.vec, kind, d).astype(np.float64), data.vec_id.to_numpy(), data.place.to_numpy()
            order = np.argsort(place)
            x, ids, place = x[order], ids[order], place[order]
            for key, group in queries.groupby("query", sort=False):
                at = np.searchsorted(place, np.concatenate([np.frombuffer(p, "<u4") for p in group.places]).astype(np.int64))
                own, least, vec = group.query_id.iloc[0], group.least.iloc[0], matrix(group.vec.iloc[:1], kind, d)[0].astype(np.float64)
                at = at[ids[at] != own]
                s = x[at] @ vec
                slack = 1e-9 * (1 + np.abs(s).max(initial=0))
                if len(at) > k:
                    least = max(least, np.partition(s, len(s) - k)[len(s) - k])
                at = at[s >= least - slack]
                # sums in order of the components: equal vectors score alike
                s = np.cumsum(x[at] * vec, axis=1)[:, -1] if len(at) else np.zeros(0)
                best = np.lexsort((ids[at], -s))[:k]
                out.append(pd.DataFrame({"query": key, "query_id": own, "vec_id": ids[at][best], "score": s[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}).astype({"query": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= k)


def nearest(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every query row the ``k`` other rows
    with the largest inner products found, ties to the smaller ``vec_id``.

    ``is_query(id column)`` tells the query rows.  Scores are double sums of the
    products in order of the components.  Fewer other rows than ``k`` give them
    all; one row alone, and an empty table, give none.  Rows that repeat an id
    and vector count once; rows that share an id are nobody's neighbours among
    themselves.  Of equal vectors only the ``k + 1`` smallest ids, all that a
    result can name, are searched.  Null, empty and zero vectors, those with a
    null or non-finite component, of another length than the commonest, or
    without an id take no part.  Other columns are ignored.
    """
    spark = table.sparkSession
    apply_recommended_conf(spark)
    rows, d, kind = packed(table, id_col, vec_col, zero=False)
    every = written(rows.distinct(), "vectors")
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    data = written(every.withColumn("nth", nth).filter(F.col("nth") <= k + 1).drop("nth"), "distinct-vectors")

    def norms(batches):
        for b in batches:
            v = matrix(b.column(0), kind, d).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((v * v).sum(axis=1)).max(initial=0, keepdims=True), pa.float64())], names=["norm"])

    size, largest = data.count(), data.select("vec").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = data.select("vec").orderBy(F.xxhash64("vec"), "vec_id").limit(SAMPLE).collect()
    model = Codes(matrix([r["vec"] for r in some], kind, d), largest, bits, FIRST * k / size)
    shared, n = spark.sparkContext.broadcast(model), bits // 16

    data = data.mapInArrow(_coded(shared, kind, d, False), "vec_id long, vec binary, code binary")
    data = written(ranked(data, [F.col("code"), F.col("vec_id"), F.col("vec")], "place", "coded"), "vector-table")
    index = data.select("code", "place").mapInArrow(_entries(n), "j int, value int, code binary, place long")
    per_block = max(ENTRIES, -(-n * size // MAX_BLOCKS))
    index = ranked(index, [F.col("j"), F.col("value"), F.col("place")], "nth", "index")
    index = written(index.select(F.floor(F.col("nth") / per_block).cast("long").alias("block"), "j", "value", "code", "place"), "index-blocks")
    edges = index.groupBy("block", "j").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()
    directory = spark.sparkContext.broadcast(tuple(np.array([r[c] for r in edges], t) for c, t in (("block", np.int64), ("j", np.int64), ("low", np.uint16), ("high", np.uint16))))

    queries = every.filter(is_query(F.col("vec_id"))).mapInArrow(_coded(shared, kind, d, True), "vec_id long, vec binary, code binary")
    queries = ranked(queries, [F.col("code"), F.col("vec_id"), F.col("vec")], "query", "asked")
    queries = written(queries.select("query", F.floor(F.col("query") / QUERY_BLOCK).cast("long").alias("qb"), F.col("vec_id").alias("query_id"), "vec", "code"), "queries")

    def search(rows: DataFrame) -> DataFrame:
        """The ``k`` best of every query (its radius and least score with it)."""
        probes = rows.select("qb", "query", "code", "radius")
        routed = written(probes.mapInArrow(_routes(directory, n), "block long, qb long, query long, code binary, radius int"), "routes")
        sent = index.join(routed.select("block", F.col("qb").alias("for_qb")).distinct(), "block")
        spots = routed.groupBy("block", "qb").cogroup(sent.groupBy("block", "for_qb")).applyInPandas(_probe(n, ENTRIES), "query long, home long, places binary")
        spots = written(spots.join(rows.select("query", "qb"), "query").select("qb", "query", "home", "places"), "spots")
        asked = spots.join(rows.select("query", "query_id", "vec", "least"), "query")
        homes = data.withColumn("home", F.floor(F.col("place") / ENTRIES).cast("long")).withColumn("place", F.col("place") % ENTRIES)
        homes = homes.select("home", "place", "vec_id", "vec").join(spots.select("home", F.col("qb").alias("for_qb")).distinct(), "home")
        found = asked.groupBy("home", "qb").cogroup(homes.groupBy("home", "for_qb")).applyInPandas(_score(k, kind, d), "query long, query_id long, vec_id long, score double")
        return _top(found, k)

    def second(batches):
        m = shared.value
        for b in batches:
            v = matrix(b.column("vec"), kind, d).astype(np.float64)
            r = m.needed(np.asarray(b.column("least")), np.sqrt((v * v).sum(axis=1))) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r, pa.int32())], names=[*b.schema.names, "radius"])

    first = written(search(queries.withColumn("radius", F.lit(model.first)).withColumn("least", F.lit(float("-inf")))), "first")
    lows = first.filter(F.col("rank") == k).select("query", F.col("score").alias("least"))
    again = queries.join(lows, "query", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    again = written(again.mapInArrow(second, "query long, qb long, query_id long, vec binary, code binary, least double, radius int"), "second").filter(F.col("radius") > model.first)
    better = search(again)
    done = first.join(again.select("query"), "query", "left_anti").unionByName(better)
    return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
