"""Hard negatives from clustered anchors that share sorted candidate lists.

Anchors are clustered around bounded centres, and cut by their angle to the
centre into clusters of bounded size.  For a cluster whose members lie at
angles ``[a, b]`` of its centre, a candidate ``x`` at angle ``t`` scores at most
``|q| |x| cos(max(0, t - b, a - t))`` with any member ``q``.  Candidates lie in
blocks of bounded size, by centre and angle; a cluster sorts the blocks by that
bound once, from summaries (the range of angles to every centre, the range of
norms), and a block's rows by their own when it is read.

All members of a cluster walk the one list, a few blocks per round and four
times as many in the next.  A member stops for certain once the bound of
what is left is below every score that it still looks for.  Positives are
found by a first walk, the negatives of every positive's score window by a
second one over the same list.  Scores are exact integers throughout.

Of equal vectors of one label only the smallest ids that a result can name are
listed, picked before the shuffle.  The centres are the only data that every
task sees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .order import ranked
from .packed import matrix, packed
from .store import written

CENTRES = 256                # at most
SAMPLE = 8192                # anchors that centres are fitted on
CLUSTER = 256                # anchors
BLOCK = 4096                 # candidates
SLAB = 1024                  # rows of a block scored at a time
FIRST, GROWTH = 4, 4         # blocks in the first round; growth per round
LARGEST = 2.0**24            # of a scaled component
FAR = 1 << 62


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; ``x`` are rows of any norm."""
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = (x / np.where(norm > 0, norm, 1))[: SAMPLE]
    centres = x[np.random.default_rng(5).permutation(len(x))[:k]]
    for _ in range(10):
        cell = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, total / np.where(size > 0, size, 1), centres)
    return centres


def angles(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to every centre."""
    norm = np.sqrt((x * x).sum(axis=1))
    long = np.sqrt((centres * centres).sum(axis=1))
    cos = x @ centres.T / (np.where(norm > 0, norm, 1)[:, None] * np.where(long > 0, long, 1))
    return norm, np.arccos(np.clip(cos, -1, 1))


def _placed(shared, d):
    """Nearest centre, angle to it and norm."""
    def run(batches):
        for b in batches:
            norm, angle = angles(matrix(b.column(1), "<i4", d).astype(np.float64), shared.value)
            cell = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(angle[np.arange(len(cell)), cell], pa.float64()), pa.array(norm, pa.float64())],
                                             names=[*b.schema.names, "cell", "angle", "norm"])

    return run


def _summaries(shared, d):
    """Of a block's rows in a batch: angles to every centre, norms."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            block = np.asarray(b.column(0))
            norm, angle = angles(matrix(b.column(1), "<i4", d).astype(np.float64), shared.value)
            for v in np.unique(block):
                at, n = block == v, angle.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, v), pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(angle[at].min(axis=0)), pa.array(angle[at].max(axis=0)),
                                                  pa.array(np.full(n, norm[at].min())), pa.array(np.full(n, norm[at].max()))], names=["block", "cell", "near", "far", "short", "long"])

    return run


def _bound(near: Column, far: Column, short: Column, long: Column) -> Column:
    """Largest score, per unit of the anchor's norm, of any row of a block."""
    cos = F.cos(F.greatest(F.lit(0.0), near - F.col("outer"), F.col("inner") - far))
    return F.when(cos >= 0, long * cos).otherwise(short * cos) + long * 1e-7 + 1e-6


def _walk_block(shared, d, k):
    """The ``k`` best of every want of the members in one block."""
    def run(members, rows):
        import pandas as pd

        out = []
        if len(members) and len(rows):
            centres, first = shared.value, members.iloc[0]
            q, x = matrix(members.vec, "<i4", d), matrix(rows.vec, "<i4", d)
            norm, angle = angles(x.astype(np.float64), centres[int(first.cell)][None])
            cos = np.cos(np.maximum(0, np.maximum(angle[:, 0] - first.outer, first.inner - angle[:, 0])))
            order = np.argsort(-norm * cos, kind="stable")
            bound = (norm * cos + norm * 1e-7 + 1e-6)[order]
            exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * d < 2.0**53
            q, x = (q.astype(np.float64), x[order].astype(np.float64)) if exact else (q.astype(np.int64), x[order].astype(np.int64))
            ids, labels = rows.vec_id.to_numpy()[order], rows.label.to_numpy()[order]
            found = [[(w, [], w["least"]) for w in ws] for ws in members.wants]
            alive = np.arange(len(q))
            for at in range(0, len(x), SLAB):
                need = np.array([min(least for _, _, least in found[i]) for i in alive])
                alive = alive[members.norm.to_numpy()[alive] * bound[at] >= need]
                if not len(alive):
                    break
                here, label = ids[at : at + SLAB], labels[at : at + SLAB]
                score = (q[alive] @ x[at : at + SLAB].T).astype(np.int64)
                for i, s in zip(alive, score, strict=True):
                    same, other = label == members.label.iloc[i], here != members.vec_id.iloc[i]
                    for m, (w, best, least) in enumerate(found[i]):
                        hit = np.flatnonzero((same == w["same"]) & other & (s >= least) & (s <= w["most"]))
                        if len(hit):
                            best = sorted([*best, *zip(-s[hit], here[hit], strict=True)])[:k]
                            found[i][m] = (w, best, max(least, -best[-1][0]) if len(best) == k else least)
            for place, wants in zip(members.place, found, strict=True):
                out += [(place, w["slot"], i, -s) for w, best, _ in wants for s, i in best]
        return pd.DataFrame(out, columns=["place", "slot", "vec_id", "score"]).astype("int64")

    return run


def _walk(anchors: DataFrame, wants: DataFrame, lists: DataFrame, data: DataFrame, shared, d: int, k: int) -> DataFrame:
    """``(place, slot, vec_id, score, rank)``: per want its ``k`` best candidates.

    A want ``(place, slot, same, least, most)`` looks for rows of the anchor's
    label, or of others, that score within ``[least, most]``.
    """
    spark = anchors.sparkSession
    want = F.struct("slot", "same", "least", "most")
    active = written(anchors.join(wants.groupBy("place").agg(F.collect_list(want).alias("wants")), "place"), "walkers")
    found = spark.createDataFrame([], "place long, slot long, vec_id long, score long, rank int")
    done, width = 0, FIRST
    best = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "vec_id")
    while active.limit(1).count():
        turn = lists.filter((F.col("pos") > done) & (F.col("pos") <= done + width)).select("cluster", "block", "bound")
        need = F.array_min(F.transform("wants", lambda w: w["least"]))
        asked = active.join(turn, "cluster").filter(F.col("norm") * F.col("bound") >= need).drop("bound")
        asked = written(asked.select("cluster", "block", "cell", "inner", "outer", "place", "vec_id", "label", "vec", "norm", "wants"), "asked")
        pairs = asked.select(F.col("cluster").alias("for_cluster"), "block").distinct()
        sent = data.join(pairs, "block").select("for_cluster", "block", "vec_id", "label", "vec")
        new = asked.groupBy("cluster", "block").cogroup(sent.groupBy("for_cluster", "block")).applyInPandas(_walk_block(shared, d, k), "place long, slot long, vec_id long, score long")
        found = found.drop("rank").unionByName(new).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = written(found, "found")
        done, width = done + width, width * GROWTH
        # what is left can matter only while its bound reaches a score still wanted
        rest = lists.filter(F.col("pos") == done + 1).select("cluster", "bound")
        kth = found.filter(F.col("rank") == k).groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
        wanted = F.transform("wants", lambda w: F.struct(w["slot"].alias("slot"), w["same"].alias("same"), F.greatest(w["least"], F.coalesce(F.try_element_at("kth", w["slot"]), w["least"])).alias("least"),
                                                        w["most"].alias("most")))
        active = active.join(kth, "place", "left").withColumn("wants", wanted).drop("kth").join(rest, "cluster")
        active = written(active.filter(F.col("norm") * F.col("bound") >= need).drop("bound"), "walkers")
    return found


def hard_negatives(table: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components count as ``floor(scale * x)``; scores are integer inner products
    with the anchor, higher first, ties to the smaller id.  An anchor's positives
    are its first ``positives`` other rows of its label; for each of them come the
    first ``negatives`` rows of other labels that score from ``low`` to ``high``
    percent of the positive's score (of a negative one: none).

    ``is_anchor(id column)`` tells the anchors.  Rows without id, label or vector,
    with a null or non-finite component or one of ``2**24`` or more after
    scaling, with an empty vector or one of another length than the commonest
    take no part; a vector of zeros does.  Rows that repeat id, vector and label
    count once; rows that share the anchor's id are neither its positives nor
    its negatives.  A table without anchors gives no rows.  Other columns are
    ignored.
    """
    spark = table.sparkSession
    apply_recommended_conf(spark)
    rows, d, _ = packed(table.filter(F.col(label_col).isNotNull()), id_col, vec_col, {"label": F.col(label_col)}, scale, LARGEST)
    every = written(rows.distinct(), "vectors")
    nth = F.row_number().over(Window.partitionBy("vec", "label").orderBy("vec_id"))
    data = every.withColumn("nth", nth).filter(F.col("nth") <= max(positives, negatives) + 1).drop("nth")
    anchors = every.filter(is_anchor(F.col("vec_id")))
    n = anchors.count()
    if not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    some = anchors.select("vec").orderBy(F.xxhash64("vec"), "vec_id").limit(SAMPLE).collect()
    centres = fit_centres(matrix([r["vec"] for r in some], "<i4", d).astype(np.float64), max(1, min(CENTRES, n // CLUSTER)))
    shared = spark.sparkContext.broadcast(centres)
    kind = table.schema[label_col].dataType.simpleString()
    schema = f"vec_id long, vec binary, label {kind}, cell int, angle double, norm double"
    order = [F.col(c) for c in ("cell", "angle", "vec_id", "vec", "label")]

    anchors = ranked(anchors.mapInArrow(_placed(shared, d), schema), order, "place", "anchors")
    cells = anchors.groupBy("cell").agg(F.min("place").alias("first"))
    anchors = anchors.join(F.broadcast(cells), "cell")          # one row per centre
    # places are below 2**40, so a cluster's number tells its cell and its part
    anchors = anchors.withColumn("cluster", F.shiftleft(F.col("cell").cast("long"), 40) + F.floor((F.col("place") - F.col("first")) / CLUSTER).cast("long")).drop("first")
    rings = written(anchors.groupBy("cluster", "cell").agg(F.min("angle").alias("inner"), F.max("angle").alias("outer")), "clusters")
    anchors = written(anchors.join(rings.drop("cell"), "cluster"), "clustered")

    data = ranked(data.mapInArrow(_placed(shared, d), schema), order, "place", "candidates")
    data = written(data.select(F.floor(F.col("place") / BLOCK).cast("long").alias("block"), "vec_id", "label", "vec"), "blocks")
    summary = data.select("block", "vec").mapInArrow(_summaries(shared, d), "block long, cell int, near double, far double, short double, long double")
    summary = summary.groupBy("block", "cell").agg(F.min("near").alias("near"), F.max("far").alias("far"), F.min("short").alias("short"), F.max("long").alias("long"))
    bound = _bound(F.col("near"), F.col("far"), F.col("short"), F.col("long"))
    lists = summary.join(rings, "cell").select("cluster", "block", bound.alias("bound"))
    lists = written(lists.withColumn("pos", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("bound"), "block"))), "lists")

    one = F.lit(0).cast("long").alias("slot"), F.lit(True).alias("same"), F.lit(-FAR).alias("least"), F.lit(FAR).alias("most")
    near = _walk(anchors, anchors.select("place", *one), lists, data, shared, d, positives)
    near = written(near.select("place", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score")
    least, most = F.ceil(score * low / F.lit(100).cast("decimal(3,0)")), F.floor(score * high / F.lit(100).cast("decimal(3,0)"))
    wants = near.filter(score >= 0).select("place", "slot", F.lit(False).alias("same"), least.cast("long").alias("least"), most.cast("long").alias("most")).filter("least <= most")
    hard = _walk(anchors, wants, lists, data, shared, d, negatives)
    out = hard.join(near, ["place", "slot"]).join(anchors.select("place", F.col("vec_id").alias("anchor_id")), "place")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
