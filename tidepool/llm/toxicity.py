"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and the 4 to 6 byte heads of longer words.  The terms that
labelled toxic texts use clearly more often than clean ones (chi-squared and
lift over the labelled sample) make the vocabulary; document frequencies are
counted over all documents.  Labelled examples are TF-IDF vectors in an
inverted index cut into blocks with the largest weight per term and block: a
block whose bound does not reach the k-th best so far is skipped, so the k
nearest are exact.  Votes are weighted by similarity and by the classes' real
shares, and calibrated by isotonic regression on leave-one-out votes.

The examples are a bounded sample of the labelled rows (``PER_CLASS`` per class,
spread evenly by a hash); everything else is counted over all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .store import written
from .textvec import NOT_ALNUM, U64, combine, list_column, text_blocks, words

PER_CLASS = 2500
MAX_TERMS, MIN_TEXTS, MIN_SHARE, MIN_CHI2, MIN_LIFT = 1500, 4, 0.01, 15.0, 20.0
NEIGHBOURS, BLOCK = 15, 64
THRESHOLD = 0.7
HEADS = (4, 5, 6)
RESULT = "struct<score:double,predicted:int,neighbours:array<bigint>>"


def _text_terms(column: pa.Array):
    """Per text: distinct term hashes and their counts."""
    for _, _, data, offsets in text_blocks(column):
        _, _, doc, h, *heads = words(data, offsets, NOT_ALNUM, HEADS)
        at = np.searchsorted(doc, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            a, b = at[i], at[i + 1]
            every = np.concatenate([h[a:b], *[x[a:b] for x in heads]])
            yield np.unique(every[every != 0], return_counts=True)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, toxic, text)`` of at most ``per_class`` documents per class,
    and the numbers of labelled documents of each class (toxic wins if a
    document has both labels)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(learn)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .join(ids.filter("doc_id is not null").distinct(), "doc_id"))
    lab = written(lab, "labels")
    size = {r["toxic"]: r["count"] for r in lab.groupBy("toxic").count().collect()}
    pick = [lab.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    picked = written(pick[0].union(pick[1]), "picked")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    return rows, size


def _select_terms(sample: DataFrame) -> np.ndarray:
    """Terms of the vocabulary.  Texts with the same smallest hash of three
    words count as one, so that a group of copies does not vote for its words."""
    def run(batches):
        for b in batches:
            toxic, terms = b.column(0).to_numpy(zero_copy_only=False), []
            for _, _, data, offsets in text_blocks(b.column(1)):
                _, _, doc, h, *heads = words(data, offsets, NOT_ALNUM, HEADS)
                at, tri = np.searchsorted(doc, np.arange(len(offsets))), combine(h, 3)
                for i in range(len(offsets) - 1):
                    x, y = at[i], at[i + 1]
                    every = np.unique(np.concatenate([h[x:y], *[g[x:y] for g in heads]]))
                    like = tri[x : y - 2].min() if y - x > 2 else U64(len(every))
                    terms.append((np.unique(np.concatenate([every, np.zeros(1, U64)])), like))
            many = [len(t) for t, _ in terms]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([t for t, _ in terms] or [np.zeros(0, U64)]).view(np.int64)), pa.array(np.repeat(toxic, many), pa.int32()),
                 pa.array(np.repeat(np.array([k for _, k in terms], U64), many).view(np.int64))], names=["term", "toxic", "like"])

    per = (sample.select("toxic", "text").mapInArrow(run, "term long, toxic int, like long").distinct().groupBy("term")
           .agg(F.sum(F.col("toxic").cast("double")).alias("a"), F.sum(1.0 - F.col("toxic")).alias("b")))
    per = written(per, "terms")
    every = per.filter("term = 0").first()
    if every is None or not every["a"] or not every["b"]:
        return np.zeros(0, U64)
    n1, n0 = every["a"], every["b"]
    c, d = n1 - F.col("a"), n0 - F.col("b")
    cross = F.col("a") * d - F.col("b") * c
    chi2 = (n1 + n0) * cross * cross / (n1 * n0 * (F.col("a") + F.col("b")) * F.greatest(c + d, F.lit(1.0)))
    lift = F.col("a") / n1 >= MIN_LIFT * (F.col("b") + 0.5) / n0
    often = F.col("a") >= max(MIN_TEXTS, MIN_SHARE * n1)
    rows = (per.withColumn("chi2", chi2).filter((F.col("term") != 0) & lift & often & (F.col("chi2") >= MIN_CHI2))
            .orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).select("term").collect())
    return np.sort(np.array([r["term"] for r in rows], np.int64).view(U64))


def _counts(vocab: np.ndarray, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(vocab):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocab, term), len(vocab) - 1)
    ok = vocab[at] == term
    return at[ok], n[ok]


def _document_frequency(docs: DataFrame, vocab: np.ndarray) -> tuple[np.ndarray, int]:
    def run(batches):
        df, n = np.zeros(len(vocab), np.int64), 0
        for b in batches:
            for term, count in _text_terms(b.column(0)):
                n += 1
                df[_counts(vocab, term, count)[0]] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([used, [-1]]), pa.int64()), pa.array(np.concatenate([df[used], [n]]), pa.int64())], names=["i", "n"])

    out, total = np.zeros(len(vocab)), 0
    for r in docs.select("text").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        if r["i"] < 0:
            total = r["n"]
        else:
            out[r["i"]] = r["n"]
    return out, total


class Examples:
    """Labelled TF-IDF vectors behind a block-max inverted index."""

    def __init__(self, vocab: np.ndarray, idf: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, share: dict[int, int]):
        self.vocab, self.idf = vocab, idf
        dense = np.zeros((len(vectors), max(1, len(vocab))), np.float32)
        for row, (at, n) in zip(dense, vectors, strict=True):
            i, w = self.vector(at, n)
            row[i] = w
        sample = {c: int((labels == c).sum()) for c in (0, 1)}
        weight = np.array([share.get(int(c), 1) / max(1, sample[int(c)]) for c in labels])
        self.prior = float((weight * labels).sum() / weight.sum()) if len(labels) else 0.0
        empty = ~dense.any(axis=1) if len(vocab) else np.ones(len(labels), bool)
        tox = float((weight * labels)[empty].sum())
        self.blank = (tox + self.prior) / (float(weight[empty].sum()) + 1.0) if len(labels) else 0.0
        # Equal vectors are one entry with the weights of both classes: no order among them.
        kept = np.flatnonzero(~empty)
        if len(kept):
            uniq, inv = np.unique(dense[kept], axis=0, return_inverse=True)
        else:
            uniq, inv = dense[:0], np.zeros(0, np.int64)
        inv = inv.reshape(-1)
        self.rows = uniq
        self.toxic = np.bincount(inv, (weight * labels)[kept], len(uniq))
        self.every = np.bincount(inv, weight[kept], len(uniq))
        first = np.full(len(uniq), np.iinfo(np.int64).max)
        np.minimum.at(first, inv, ids[kept])
        self.ids = first
        self.blocks = [slice(i, min(i + BLOCK, len(uniq))) for i in range(0, len(uniq), BLOCK)]
        self.block_max = np.array([uniq[b].max(axis=0) for b in self.blocks]) if self.blocks else np.zeros((0, dense.shape[1]))
        self.calibrate(dense[kept], inv, (weight * labels)[kept], weight[kept])

    def vector(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1.0 + np.log(n)) * self.idf[at]
        norm = float(np.sqrt((w * w).sum()))
        return (at, (w / norm).astype(np.float32)) if norm else (at[:0], np.zeros(0, np.float32))

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the k nearest with a positive cosine (ties: smaller entry)."""
        bound = self.block_max[:, at] @ w if len(at) else np.zeros(0)
        best, sims = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(sims) >= k and bound[b] < sims[k - 1] - 1e-6):
                break
            block = self.blocks[b]
            got = self.rows[block][:, at] @ w
            sims = np.concatenate([sims, got])
            best = np.concatenate([best, np.arange(block.start, block.stop)])
            order = np.lexsort((best, -sims))[:k]
            best, sims = best[order], sims[order]
        keep = sims > 0
        return best[keep], sims[keep]

    def vote(self, near: np.ndarray, sims: np.ndarray, minus: tuple[int, float, float] | None = None) -> float | None:
        tox, every = self.toxic[near], self.every[near]
        if minus is not None:
            mine = near == minus[0]
            tox, every = tox - mine * minus[1], every - mine * minus[2]
        total = float((sims * every).sum())
        return float((sims * tox).sum() / total) if total > 1e-12 else None

    def calibrate(self, dense: np.ndarray, inv: np.ndarray, tox: np.ndarray, every: np.ndarray) -> None:
        """Isotonic fit of the label on the leave-one-out vote."""
        got = []
        for row, entry, t, e in zip(dense, inv, tox, every, strict=True):
            at = np.flatnonzero(row)
            near, sims = self.nearest(at, row[at], NEIGHBOURS + 1)
            v = self.vote(near, sims, (int(entry), float(t), float(e)))
            if v is not None:
                got.append((v, t / e, e))
        got.sort()
        pools: list[list[float]] = []
        for v, y, w in got:
            pools.append([v, v, y * w, w])
            while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
                b = pools.pop()
                a = pools[-1]
                pools[-1] = [a[0], b[1], a[2] + b[2], a[3] + b[3]]
        x, y = [0.0], [0.0]
        for lo, hi, t, w in pools:
            p = (t + self.prior) / (w + 1.0)
            x += [lo, hi]
            y += [p, p]
        self.curve = (np.array([*x, 1.0]), np.maximum.accumulate(np.array([*y, max(y[-1], 0.99 if pools else 0.0)])))

    def score(self, at: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
        near, sims = self.nearest(*self.vector(at, n), NEIGHBOURS)
        v = self.vote(near, sims)
        if v is None:
            return min(1.0, max(0.0, self.blank)), near
        return float(np.clip(np.interp(v, *self.curve), 0.0, 1.0)), near


def learn_examples(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Examples:
    """Vocabulary and index from the labelled rows that ``learn`` allows."""
    sample, share = labelled_sample(docs, labels, learn, per_class)
    sample = written(sample, "labelled")
    vocab = _select_terms(sample)
    df, total = _document_frequency(docs, vocab)
    idf = np.log((1.0 + total) / (1.0 + df))

    def run(batches):
        for b in batches:
            got = [_counts(vocab, t, n) for t, n in _text_terms(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), list_column([a for a, _ in got], pa.int64()), list_column([n for _, n in got], pa.int64())], names=["doc_id", "toxic", "at", "n"])

    rows = sample.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, at array<long>, n array<long>").toArrow().to_pydict()
    vectors = [(np.array(a, np.int64), np.array(n, np.int64)) for a, n in zip(rows["at"], rows["n"], strict=True)]
    return Examples(vocab, idf, vectors, np.array(rows["toxic"], np.int64), np.array(rows["doc_id"], np.int64), share)


def _score_udf(shared, threshold: float):
    def run(text: pa.Array) -> pa.Array:
        ex, score, near = shared.value, [], []
        for term, n in _text_terms(text):
            s, hit = ex.score(*_counts(ex.vocab, term, n))
            score.append(s)
            near.append(ex.ids[hit])
        return pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()), list_column(near, pa.int64())],
                                          names=["score", "predicted", "neighbours"])

    return F.arrow_udf(run, RESULT)


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_col: str = "text", name: str = "toxicity",
             per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` with a struct column ``name``: score, predicted, and
    the ids of the nearest examples (the smallest id of equal vectors).

    Null and empty texts, and texts without any term of the vocabulary, get the
    score of the labelled texts without one.  Labels of unknown documents, null
    labels and null ids teach nothing; without labels of both classes all score
    the share of toxic labels (0 without labels).  Repeated rows score alike.
    """
    apply_recommended_conf(docs.sparkSession)
    examples = learn_examples(docs.select(F.col("doc_id"), F.col(text_col).alias("text")), labels, F.lit(True) if learn is None else learn, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(examples)
    return docs.withColumn(name, _score_udf(shared, threshold)(F.col(text_col)))


def drop_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    name = "toxicity"
    while name in docs.columns:
        name += "_"
    return toxicity(docs, labels, name=name, **how).filter(F.col(name)["predicted"] == 0).select(docs.columns)
