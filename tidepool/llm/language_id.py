"""Language ID by a string kernel with Nystroem landmarks.

A text's features are the character n-grams (1 to 3) that occur in it, over
all letters of any script (everything else is a gap), hashed to ``WIDTH``
features.  The kernel of two texts is their common n-grams over the
geometric mean of their numbers.  Landmark texts give Nystroem features;
one-versus-rest kernel ridge regression on them gives one weight column per
language.  Landmarks stay sparse (lists of the landmarks that hold an n-gram);
as the kernel is a product of presences, ``(X M') W`` is ``X (M' W)``: the right
factor, a row per n-gram of the landmarks and a column per language, is
multiplied once, and a batch of texts is scored by products of its presences
with the rows that occur in it.

Training uses a bounded sample (``PER_LANG`` texts of every language present,
``LANDMARKS`` of them as landmarks); every text is scored whole.
"""

from __future__ import annotations

import functools
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .store import written
from .textvec import SLOT, U64, mix

PER_LANG, LANDMARKS = 300, 24
RIDGE, BATCH = 1e-3, 32
#: n-grams are hashed to so many features.
WIDTH = 1 << 20
#: n-grams of a batch that one product takes.
COLUMNS = 4096
UNKNOWN = "und"
RESULT = "struct<lang_pred:string,score:double>"


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


class Alphabet:
    """Presence of hashed n-grams of letters; every other code point is a gap.
    ``letters`` count as letters besides those of Unicode."""

    def __init__(self, letters: str = ""):
        self.letters = np.array(sorted({ord(c) for c in letters}), np.uint32)

    def symbols(self, text: str) -> np.ndarray:
        p = _points(text)
        ok = _letters()[p]
        if len(self.letters):
            ok |= np.isin(p, self.letters)
        return np.where(ok, p, 0).astype(np.uint64)

    def grams(self, text: str) -> np.ndarray | None:
        """The numbers of the n-grams that occur, each once (runs of gaps are
        one); None: no letter.  Time and memory are linear in the text."""
        s = self.symbols(text)
        if not s.any():
            return None
        s = np.concatenate([[U64(0)], s, [U64(0)]])
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
        # Code points have 21 bits; a lone gap (0) is no n-gram.
        two = (s[:-1] << U64(21)) | s[1:]
        three = (two[:-1] << U64(21)) | s[2:]
        every = np.concatenate([mix(g ^ SLOT[n]) for n, g in enumerate((s[s != 0], two, three), 1)])
        every = (every % U64(WIDTH)).astype(np.int32)
        # Of equal numbers the place written last stays; older marks need no clearing.
        at = np.arange(len(every), dtype=np.int32)
        last = _last_place()
        last[every] = at
        return every[last[every] == at]

    def flags(self, text: str) -> np.ndarray | None:
        """Presence of every n-gram, as ``WIDTH`` flags."""
        g = self.grams(text)
        if g is None:
            return None
        out = np.zeros(WIDTH, bool)
        out[g] = True
        return out


@functools.cache
def _last_place() -> np.ndarray:
    return np.zeros(WIDTH, np.int32)


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], bool)


class Model:
    """Landmarks and one weight column per language."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.alphabet = Alphabet()
        rows = [(f, g) for t, g in zip(texts, langs, strict=True) if (f := self.alphabet.grams(t)) is not None]
        self.langs = sorted({g for _, g in rows})
        if not rows:
            return
        taken: Counter[str] = Counter()
        marks = []
        for i, (_, g) in enumerate(rows):
            taken[g] += 1
            if taken[g] <= LANDMARKS:
                marks.append(i)
        held = np.concatenate([rows[i][0] for i in marks])
        owner = np.repeat(np.arange(len(marks), dtype=np.int32), [len(rows[i][0]) for i in marks])
        order = np.argsort(held, kind="stable")
        self.vocab, first = np.unique(held[order], return_index=True)
        self.holders, self.first = owner[order], np.append(first, len(held))
        self.norm = np.sqrt(np.array([len(rows[i][0]) for i in marks], np.float64))
        value, vector = np.linalg.eigh(self.kernel([rows[i][0] for i in marks]))
        keep = value > 1e-8 * value[-1]
        root = vector[:, keep] / np.sqrt(value[keep])
        size = Counter(g for _, g in rows)
        mean = len(size) / len(rows)
        left, right = np.zeros((root.shape[1],) * 2), np.zeros((root.shape[1], len(self.langs)))
        for i in range(0, len(rows), BATCH):
            part = rows[i : i + BATCH]
            z = self.kernel([f for f, _ in part]) @ root
            y = np.array([[1.0 if g == x else -1.0 for x in self.langs] for _, g in part])
            weighed = z * np.array([1.0 / (size[g] * mean) for _, g in part])[:, None]
            left += weighed.T @ z
            right += weighed.T @ y
        beta = np.linalg.solve(left + RIDGE * len(rows) * np.eye(len(left)), right)
        # A row per n-gram of the landmarks: the weights of its holders, summed.
        of_mark = (root @ beta) / self.norm[:, None]
        self.weights = np.empty((len(self.vocab), len(self.langs)), np.float32)
        for c in range(len(self.langs)):
            self.weights[:, c] = np.add.reduceat(of_mark[self.holders, c], self.first[:-1])
        del self.holders, self.first

    def known(self, grams: np.ndarray) -> np.ndarray:
        """The places in the vocabulary of the n-grams that landmarks hold."""
        at = np.minimum(np.searchsorted(self.vocab, grams), len(self.vocab) - 1)
        return at[self.vocab[at] == grams]

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel of texts and landmarks, from the lists of holders."""
        out = np.zeros((len(grams), len(self.norm)))
        for row, g in zip(out, grams, strict=True):
            at = self.known(g)
            start, many = self.first[at], self.first[at + 1] - self.first[at]
            lists = np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())
            row[:] = np.bincount(self.holders[lists], minlength=len(row)) / np.sqrt(len(g))
        return out / self.norm

    def products(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel times weights, over the n-grams of the batch in blocks of columns."""
        own = [self.known(g) for g in grams]
        text = np.repeat(np.arange(len(own)), [len(a) for a in own])
        held, at = np.unique(np.concatenate(own), return_inverse=True)
        order = np.argsort(at, kind="stable")
        text, at = text[order], at[order]
        out = np.zeros((len(grams), len(self.langs)), np.float32)
        for b in range(0, len(held), COLUMNS):
            lo, hi = np.searchsorted(at, [b, b + COLUMNS])
            there = np.zeros((len(grams), min(COLUMNS, len(held) - b)), np.float32)
            there[text[lo:hi], at[lo:hi] - b] = 1.0
            out += there @ self.weights[held[b : b + COLUMNS]]
        return out / np.sqrt(np.array([len(g) for g in grams], np.float32))[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return lang, score
        for i in range(0, len(texts), BATCH):
            part = [(n, f) for n in range(i, min(i + BATCH, len(texts))) if texts[n] and (f := self.alphabet.grams(texts[n])) is not None]
            if not part:
                continue
            out = self.products([f for _, f in part])
            p = np.clip((out + 1.0) / 2.0, 1e-6, 1.0)
            p /= p.sum(axis=1, keepdims=True)
            for (n, _), row in zip(part, p, strict=True):
                best = int(row.argmax())
                lang[n], score[n] = self.langs[best], float(row[best])
        return lang, score


def learn_languages(rows: DataFrame) -> Model:
    """Model from ``rows(text, lang)``; rows with a null or no letters teach nothing."""
    rows = rows.filter("text is not null and lang is not null")
    pick = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    sample = (rows.select("lang", F.xxhash64("text").alias("h")).distinct()
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("nth") <= PER_LANG))
    sample = written(sample, "languages")
    found = (rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(sample), ["lang", "h"])
             .withColumn("one", F.row_number().over(pick.partitionBy("lang", "h").orderBy("text"))).filter("one = 1")
             .select("lang", "text", "nth").toArrow().to_pydict())
    order = sorted(range(len(found["nth"])), key=lambda i: (found["nth"][i], found["lang"][i]))
    return Model([found["text"][i] for i in order], [found["lang"][i] for i in order])


def _predict_udf(shared):
    def run(text: pa.Array) -> pa.Array:
        lang, score = shared.value.predict(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, RESULT)


def language_id(docs: DataFrame, learn: Column | None = None, text_col: str = "text", lang_col: str = "lang", name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name``: lang_pred and score (0 to 1).

    Learns from the rows of ``docs`` that ``learn`` allows and that have a text
    and a language.  A null text, or one without letters, is ``und`` with score
    0, and so is everything when nothing can be learned.  Equal texts get equal
    results; other columns stay; an empty table stays empty.
    """
    apply_recommended_conf(docs.sparkSession)
    rows = docs.filter(F.lit(True) if learn is None else learn).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(learn_languages(rows))
    return docs.withColumn(name, _predict_udf(shared)(F.col(text_col)))
