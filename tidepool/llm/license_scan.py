"""License scans with a trained paragraph classifier.

A paragraph is a line with words.  Its features are the word 1- to 3-grams that
occur in license texts, each weighing one over the root of the paragraph's
number of n-grams.  Multinomial logistic regression, trained here on notices
(the templates, whole, cut and with foreign words) against paragraphs of the
corpus, gives a probability per license family and for ``none``; a temperature
fitted on held-out paragraphs calibrates it.  A paragraph that is a license but
whose family stays under ``CERTAIN``, or that no template of the family confirms by
shared 3-grams, is ``unknown``.

Training sees a bounded sample (``PARAGRAPHS`` of each of ``SAMPLE_DOCS`` texts); every paragraph of
every document is classified, without a shuffle.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .textvec import NOT_ALNUM, U64, combine, list_column, mix, text_blocks, words

SAMPLE_DOCS, PARAGRAPHS = 1500, 4          # paragraphs of a sampled document
CERTAIN, CONFIRMED = 0.5, 0.5
NONE, UNKNOWN = "none", "unknown"
RESULT = "struct<license:string,families:array<string>,n_paragraphs:bigint,n_license:bigint,probability:double,similarity:double>"

#: Short public notices of each license family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "Released under the GNU GPL v2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}


def paragraphs(column: pa.Array):
    """``(block's first row, rows, row per paragraph, its first word, words of the block)``."""
    for first, last, data, offsets in text_blocks(column):
        s, _, doc, h = words(data, offsets, NOT_ALNUM)
        line = np.searchsorted(np.flatnonzero(data == 10), s) + doc * (len(data) + 1)
        head = np.flatnonzero(np.concatenate([[True], np.diff(line) != 0])) if len(s) else np.zeros(0, np.int64)
        yield first, last, doc[head], head, h


def ngrams(h: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all 1- to 3-grams inside paragraphs, the paragraph of each, and
    the number of n-grams per paragraph."""
    par = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(h))))
    keys, owner = [h], [par]
    for n in (2, 3):
        ok = par[: len(h) - n + 1] == par[n - 1 :] if len(h) >= n else np.zeros(0, bool)
        keys.append(combine(h, n)[ok])
        owner.append(par[: len(h) - n + 1][ok] if len(h) >= n else par[:0])
    owner = np.concatenate(owner)
    return np.concatenate(keys), owner, np.bincount(owner, minlength=len(head))


class Classifier:
    """Sparse multinomial logistic regression over license n-grams."""

    def __init__(self, negatives: list[np.ndarray], seed: int = 7):
        rng = random.Random(seed)
        self.families = [NONE, *sorted(TEMPLATES)]
        hashes = {f: [_words(t) for t in ts] for f, ts in TEMPLATES.items()}
        self.templates = {f: [np.unique(combine(h, 3)) if len(h) >= 3 else np.unique(h) for h in hs] for f, hs in hashes.items()}
        self.vocab = np.unique(np.concatenate([ngrams(h, np.zeros(1, np.int64))[0] for hs in hashes.values() for h in hs]))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.vocab & U64((1 << 20) - 1)).astype(np.int64)] = True
        known = set(np.unique(np.concatenate([t for ts in self.templates.values() for t in ts])).tolist())
        clean = [p for p in negatives if len(p) and not (len(p) >= 3 and np.isin(combine(p, 3), np.fromiter(known, U64)).any())]
        foreign = np.concatenate([*clean, np.arange(1, 50, dtype=U64)])
        rows, label = [], []
        for n, f in enumerate(self.families[1:], 1):
            for h in hashes[f]:
                for _ in range(24):
                    w = list(h)
                    if rng.random() < 0.4:
                        w = [x if rng.random() > 0.08 else foreign[rng.randrange(len(foreign))] for x in w]
                    if rng.random() < 0.3 and len(w) > 12:
                        a = rng.randrange(len(w) // 3)
                        w = w[a : a + rng.randrange(len(w) // 2, len(w) + 1)]
                    extra = [foreign[rng.randrange(len(foreign))] for _ in range(rng.choice([0, 0, 1, 3, 6]))]
                    rows.append(np.array(w + extra if rng.random() < 0.5 else extra + w, U64))
                    label.append(n)
        # License words out of order, or few of them, are no license.
        pool = np.concatenate([h for hs in hashes.values() for h in hs])
        for _ in range(300):
            mix = [pool[rng.randrange(len(pool))] if rng.random() < 0.3 else foreign[rng.randrange(len(foreign))] for _ in range(rng.randrange(4, 40))]
            clean.append(np.array(mix, U64))
        rows += clean
        label += [0] * len(clean)
        order = list(range(len(rows)))
        rng.shuffle(order)
        cut = len(order) // 5
        y = np.array(label)
        self.weights = np.zeros((len(self.vocab), len(self.families)))
        self.bias = np.zeros(len(self.families))
        self.temperature = 1.0
        self._fit([rows[i] for i in order[cut:]], y[order[cut:]])
        logits = self.logits(*_join([rows[i] for i in order[:cut]]))
        grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0]
        self.temperature = min(grid, key=lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(cut), y[order[:cut]]], 1e-12)).mean())

    def features(self, h: np.ndarray, head: np.ndarray):
        key, owner, n = ngrams(h, head)
        maybe = np.flatnonzero(self.filter[(key & U64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocab, key[maybe]), len(self.vocab) - 1)
        ok = self.vocab[at] == key[maybe]
        at, owner = at[ok], owner[maybe[ok]]
        return at, owner, 1.0 / np.sqrt(np.maximum(n[owner], 1))

    def logits(self, h: np.ndarray, head: np.ndarray) -> np.ndarray:
        at, owner, value = self.features(h, head)
        out = np.tile(self.bias, (len(head), 1))
        np.add.at(out, owner, self.weights[at] * value[:, None])
        return out

    def _fit(self, rows: list[np.ndarray], y: np.ndarray, steps: int = 300, rate: float = 4.0, ridge: float = 2e-5) -> None:
        at, owner, value = self.features(*_join(rows))
        goal = np.eye(len(self.families))[y]
        order = np.argsort(at, kind="stable")
        at, owner, value = at[order], owner[order], value[order]
        head = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0]))
        by_row = np.argsort(owner, kind="stable")
        row_head = np.flatnonzero(np.concatenate([[True], np.diff(owner[by_row]) != 0]))
        speed = np.zeros_like(self.weights)
        for _ in range(steps):
            z = np.tile(self.bias, (len(rows), 1))
            z[owner[by_row][row_head]] += np.add.reduceat(self.weights[at[by_row]] * value[by_row][:, None], row_head, axis=0)
            g = (_softmax(z) - goal) / len(rows)
            grad = ridge * self.weights
            grad[at[head]] += np.add.reduceat(g[owner] * value[:, None], head, axis=0)
            speed = 0.9 * speed + grad
            self.weights -= rate * speed
            self.bias -= rate * 0.1 * g.sum(axis=0)

    def classify(self, h: np.ndarray, head: np.ndarray) -> list[tuple[int, str, float, float]]:
        """``(paragraph, family or unknown, probability of a license, similarity)``
        of the paragraphs that are licenses."""
        at, owner, _ = self.features(h, head)
        some = np.unique(owner)
        if not len(some):
            return []
        end = np.append(head, len(h))
        cut = [h[end[i] : end[i + 1]] for i in some]
        p = _softmax(self.logits(*_join(cut)) / self.temperature)
        out = []
        for i, w, row in zip(some, cut, p, strict=True):
            license_p = 1.0 - float(row[0])
            best = 1 + int(row[1:].argmax())
            if license_p < CERTAIN:
                continue
            family = self.families[best]
            sim = self.similarity(w, family)
            out.append((int(i), family if row[best] >= CERTAIN and sim >= CONFIRMED else UNKNOWN, license_p, sim))
        return out

    def similarity(self, w: np.ndarray, family: str) -> float:
        """Best containment of a template's 3-grams in the paragraph or the other way round."""
        mine = {len(w) >= 3: np.unique(combine(w, 3)), False: np.unique(w)} if len(w) >= 3 else {False: np.unique(w)}
        best = 0.0
        for t, h in zip(self.templates[family], TEMPLATES[family], strict=True):
            m = mine.get(True) if len(_words(h)) >= 3 else mine[False]
            if m is not None and len(m):
                both = len(np.intersect1d(t, m, assume_unique=True))
                best = max(best, both / len(t), both / len(m))
        return best


def _words(text: str) -> np.ndarray:
    return next(paragraphs(pa.array([text])))[4]


def _join(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = [r if len(r) else np.zeros(1, U64) for r in rows]
    head = np.concatenate([[0], np.cumsum([len(r) for r in rows])])[:-1].astype(np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, U64)), head


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def negatives(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, per_doc: int = PARAGRAPHS) -> list[np.ndarray]:
    """Word hashes of paragraphs of ``sample_docs`` texts: of every one the
    ``per_doc`` distinct paragraphs of smallest hash, whatever its length and
    however the rows lie in partitions and batches."""
    def run(batches):
        for b in batches:
            at, rows = [], []
            for first, _, doc, head, h in paragraphs(b.column(0)):
                if not len(head):
                    continue
                end = np.append(head, len(h))
                key = mix(np.add.reduceat(mix(h + np.arange(len(h), dtype=U64) - np.repeat(head, np.diff(end)).astype(U64)), head))
                order = np.lexsort((key, doc))
                new = np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(doc[order]) != 0)])
                order = order[new]
                start = np.searchsorted(doc[order], doc[order])
                for i in order[np.arange(len(order)) - start < per_doc]:
                    at.append(first + int(doc[i]))
                    rows.append(h[end[i] : end[i + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(at, pa.int64())), list_column(rows, pa.int64())], names=["h", "words"])

    picked = docs.select(F.xxhash64(text_col).alias("h")).distinct().orderBy("h").limit(sample_docs)
    texts = docs.withColumn("__h", F.xxhash64(text_col)).join(F.broadcast(picked), F.col("__h") == F.col("h")).select(F.col(text_col).alias("text"), "h")
    found = texts.dropDuplicates(["h"]).mapInArrow(run, "h long, words array<long>").toArrow()
    rows = sorted(zip(found.column("h").to_pylist(), found.column("words").to_pylist(), strict=True))
    return [np.array(w, np.int64).view(U64) for _, w in rows]


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Classifier:
    """Classifier with the paragraphs of a bounded sample as negatives; sampled
    paragraphs that share three words in a row with a template are left out."""
    return Classifier(negatives(docs, text_col, sample_docs))


def _scan_udf(shared):
    kinds = pa.struct([("license", pa.string()), ("families", pa.list_(pa.string())), ("n_paragraphs", pa.int64()), ("n_license", pa.int64()), ("probability", pa.float64()), ("similarity", pa.float64())])

    def run(text: pa.Array) -> pa.Array:
        model, out = shared.value, []
        for first, last, doc, head, h in paragraphs(text):
            count = np.bincount(doc, minlength=last - first)
            found: dict[int, list] = {}
            for i, family, p, sim in model.classify(h, head) if len(head) else ():
                found.setdefault(int(doc[i]), []).append((p, sim, family))
            for d in range(last - first):
                got = found.get(d, [])
                best = max(got, key=lambda x: (x[2] != UNKNOWN, x[0], x[1], x[2]), default=(0.0, 0.0, NONE))
                out.append({"license": best[2], "families": sorted({f for _, _, f in got}), "n_paragraphs": int(count[d]), "n_license": len(got), "probability": round(best[0], 6), "similarity": best[1]})
        return pa.array(out, kinds)

    return F.arrow_udf(run, RESULT)


def license_scan(docs: DataFrame, text_col: str = "text", name: str = "license") -> DataFrame:
    """``docs`` with a struct column ``name``: the license (a family, ``unknown`` or
    ``none``), all families found, and the paragraphs, license paragraphs,
    probability and template similarity behind it.

    A confirmed family goes before ``unknown``; ties fall to the more probable,
    then more similar, then last family by name.  Null and empty texts have no
    paragraphs and are ``none``; equal texts get equal results; other columns
    stay; an empty table stays empty.
    """
    apply_recommended_conf(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    return docs.withColumn(name, _scan_udf(shared)(F.col(text_col)))
