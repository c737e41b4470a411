"""Benchmark decontamination by greedy string tiling.

A document and a test item that share a seed of ``min_match`` words (rolling
Karp-Rabin hashes over word hashes) are tiled: all maximal common runs, the
longest first, mark the words they cover in either text; what overlaps marked
words is cut and tried again, down to runs of ``min_match`` words.  The marked
share of the item's words is its coverage, whatever the order of the passages
in the document.  A document that covers an item to ``threshold`` leaks it.

The benchmark is read in blocks of at most ``MAX_BLOCK_WORDS`` words; each block
is one pass over the rows without a shuffle, so passages that many documents
share, or a hot source, give no large group.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .textvec import NOT_ALNUM, combine, text_blocks, words

MIN_MATCH, THRESHOLD = 5, 0.6
MAX_BLOCK_WORDS = 1_000_000
RESULT = "struct<contaminated:boolean,item_id:bigint,coverage:double,items:array<bigint>>"


def _word_hashes(text: str) -> np.ndarray:
    for _, _, data, offsets in text_blocks(pa.array([text])):
        return words(data, offsets, NOT_ALNUM)[3]
    return np.zeros(0, np.uint64)


class Items:
    """A block of test items and the index of their seeds."""

    def __init__(self, rows: list[tuple[int | None, str]], min_match: int):
        self.min_match = min_match
        self.ids, self.words = [], []
        for i, text in rows:
            if len(h := _word_hashes(text or "")):
                self.ids.append(i)
                self.words.append(h)
        self.seeds = {}
        for m in {min(min_match, len(h)) for h in self.words}:
            found = [(combine(h, m), n) for n, h in enumerate(self.words) if min(min_match, len(h)) == m]
            key = np.concatenate([k for k, _ in found])
            item = np.concatenate([np.full(len(k), n) for k, n in found])
            pos = np.concatenate([np.arange(len(k)) for k, _ in found])
            order = np.argsort(key, kind="stable")
            self.seeds[m] = (key[order], item[order], pos[order])

    def coverages(self, h: np.ndarray) -> list[tuple[int, float]]:
        """``(item number, coverage)`` of the items that a text shares a seed with."""
        meets: dict[int, list[np.ndarray]] = {}
        for m, (key, item, pos) in self.seeds.items():
            sh = combine(h, m)
            lo = np.searchsorted(key, sh)
            hit = np.flatnonzero(key[np.minimum(lo, len(key) - 1)] == sh) if len(sh) else lo
            if not len(hit):
                continue
            many = np.searchsorted(key, sh[hit], "right") - lo[hit]
            at = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            doc_pos = np.repeat(hit, many)
            for n in np.unique(item[at]):
                mine = item[at] == n
                meets[int(n)] = [pos[at][mine], doc_pos[mine]]
        return [(n, tile(p, d, min(self.min_match, len(self.words[n])), len(self.words[n]))) for n, (p, d) in sorted(meets.items())]


def tile(item_pos: np.ndarray, doc_pos: np.ndarray, m: int, n_words: int) -> float:
    """Share of the item's words that greedy tiles cover; the arrays are the
    seeds that the item and the text share (``m`` words from these positions)."""
    order = np.lexsort((item_pos, doc_pos - item_pos))
    p, diag = item_pos[order], (doc_pos - item_pos)[order]
    head = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (np.diff(diag) != 0)]))
    length = np.diff(np.concatenate([head, [len(p)]])) + m - 1
    heap = [(-int(n), int(p[i]), int(p[i] + diag[i])) for i, n in zip(head, length, strict=True)]
    heapq.heapify(heap)
    in_item = np.zeros(n_words, bool)
    in_doc: set[int] = set()
    while heap and not in_item.all():
        n, i, j = heapq.heappop(heap)
        n = -n
        free = [not in_item[i + x] and j + x not in in_doc for x in range(n)]
        if all(free):
            in_item[i : i + n] = True
            in_doc.update(range(j, j + n))
            continue
        start = None
        for x, ok in enumerate([*free, False]):
            if ok and start is None:
                start = x
            elif not ok and start is not None:
                if x - start >= m:
                    heapq.heappush(heap, (start - x, i + start, j + start))
                start = None
    return float(in_item.sum()) / n_words


def _leaks(benchmark: DataFrame, min_match: int, threshold: float):
    """One text function for each block of the benchmark."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    total = items.agg(F.sum(size).alias("n")).first()["n"] or 0
    parts = max(1, -(-int(total) // MAX_BLOCK_WORDS))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        shared = benchmark.sparkSession.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in rows], min_match))
        yield _leak_udf(shared, threshold)


def _leak_udf(shared, threshold: float):
    def run(text: pa.Array) -> pa.Array:
        block, out = shared.value, []
        for _, _, data, offsets in text_blocks(text):
            _, _, doc, h = words(data, offsets, NOT_ALNUM)
            at = np.searchsorted(doc, np.arange(len(offsets)))
            for i in range(len(offsets) - 1):
                got = block.coverages(h[at[i] : at[i + 1]])
                best = max(got, key=lambda x: (x[1], block.ids[x[0]] is not None, -(block.ids[x[0]] or 0)), default=None)
                leaked = sorted({block.ids[n] for n, c in got if c >= threshold}, key=lambda i: (i is None, i or 0))
                out.append({"contaminated": bool(leaked), "item_id": block.ids[best[0]] if best else None, "coverage": best[1] if best else 0.0, "items": leaked})
        return pa.array(out, pa.struct([("contaminated", pa.bool_()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("items", pa.list_(pa.int64()))]))

    return F.arrow_udf(run, RESULT)


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", min_match: int = MIN_MATCH,
                  threshold: float = THRESHOLD, name: str = "leak") -> DataFrame:
    """``docs`` with a struct column ``name``: contaminated, the item covered
    best (the smallest id on ties) with its coverage, and the leaked items.

    A null or empty text leaks nothing (coverage 0, no item).  Items without
    words take no part; one without id is reported as null, last.  Items shorter than ``min_match`` words must
    occur whole.  Repeated rows each get their result; other columns stay.
    """
    apply_recommended_conf(docs.sparkSession)
    out, one = docs, F.col
    cols = []
    for i, udf in enumerate(_leaks(benchmark, min_match, threshold)):
        cols.append(f"__{name}_{i}")
        out = out.withColumn(cols[-1], udf(one(text_col)))
    if len(cols) == 1:
        return out.withColumnRenamed(cols[0], name)
    best = F.array_max(F.transform(F.array(*cols), lambda x: F.struct(x["coverage"].alias("c"), (-x["item_id"]).alias("i"))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(F.array(*cols), lambda x: x["items"]))))
    return out.withColumn(name, F.struct((F.size(items) > 0).alias("contaminated"), (-best["i"]).alias("item_id"),
                                         best["c"].alias("coverage"), items.alias("items"))).drop(*cols)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    name = "leak"
    while name in docs.columns:
        name += "_"
    return contamination(docs, benchmark, name=name, **how).filter(~F.col(name)["contaminated"]).select(docs.columns)
