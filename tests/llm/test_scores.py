import random

import numpy as np
import pytest

from tidepool.llm import language_id as L
from tidepool.llm import queries as Q
from tidepool.llm import toxicity as T
from tidepool.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def test_nearest_is_exact():
    rng = np.random.default_rng(1)
    vocab = np.arange(40, dtype=np.uint64)
    vec = [(np.sort(rng.choice(40, rng.integers(0, 6), replace=False)), rng.integers(1, 4, 5)) for _ in range(400)]
    vec = [(a, n[: len(a)] if len(a) <= 5 else np.ones(len(a), int)) for a, n in vec]
    y = rng.integers(0, 2, 400)
    ex = T.Examples(vocab, rng.random(40) + 0.5, vec, y, np.arange(400), {0: 900, 1: 100})
    for at, n in vec[:80]:
        i, w = ex.vector(at, n)
        near, sims = ex.nearest(i, w, 15)
        every = ex.rows[:, i] @ w if len(i) else np.zeros(len(ex.rows))
        want = np.sort(every[every > 0])[::-1][:15]
        assert np.allclose(sims, want, atol=1e-5) and np.allclose(every[near], sims, atol=1e-5)
        assert 0 <= ex.score(at, n)[0] <= 1


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op10_toxicity(spark, sf).collect()}
    y = {r.doc_id: r.toxic for r in read_table(spark, sf, "labels").collect()}
    held = [d for d in y if d in got and got[d].held_out]
    assert np.mean([got[d].predicted for d in held if y[d] == 1]) >= 0.85
    assert np.mean([got[d].predicted for d in held if y[d] == 0]) <= 0.02
    assert all((r.score >= 0.7) == bool(r.predicted) and 0 <= r.score <= 1 for r in got.values())


ODD = [(1, None, "x"), (2, "", "y"), (None, "idiot trash", None), (3, "idiot " * 30000, "z"), (3, "idiot " * 30000, "z"), (4, "12 34 !!", "x")]


def test_toxicity_odd_rows(spark):
    rng = random.Random(2)
    rows = ODD + [(10 + i, " ".join([rng.choice("abcdefgh") for _ in range(9)] + ["idiot"] * (i % 4 == 0)), "q") for i in range(200)]
    docs = spark.createDataFrame([(d, t, 0.5, g) for d, t, g in rows], "doc_id long, text string, toxicity double, lang string")
    labels = spark.createDataFrame([(10 + i, int(i % 4 == 0)) for i in range(100)] + [(10, 1), (None, 1), (11, None), (9999, 1)], "doc_id long, toxic int")
    got = {(r.doc_id, r.text): r.tox for r in T.toxicity(docs, labels, name="tox").collect()}
    assert got[3, "idiot " * 30000].predicted == 1 and got[1, None].predicted == 0 and got[2, ""].score == got[1, None].score
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.filter("text like '%idiot%'").count() == 0 and kept.count() == 153
    assert {r.tox.score for r in T.toxicity(docs, labels.limit(0), name="tox").collect()} == {0.0}
    assert T.drop_toxic(docs.limit(0), labels).count() == 0


def test_language_held_out(spark):
    rows = Q.op6_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in read_table(spark, SF, "documents").collect()}
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    acc = np.mean([r.lang_pred == lang[r.doc_id] for r in held])
    print("accuracy", acc, [(r.lang_pred, lang[r.doc_id], r.score) for r in held if r.lang_pred != lang[r.doc_id]][:9])
    assert len(held) > 100 and acc >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("learn", [True, False])
def test_language_odd_rows(spark, learn):
    rows = [(d, t, g) for d, t, g in ODD] + [(20 + i, f"der die das {i}", "de") for i in range(20)] + [(50 + i, f"the of and {i} 𝄞", "en") for i in range(20)]
    docs = spark.createDataFrame([(d, t, g, "s") for d, t, g in rows], "doc_id long, text string, lang string, language string")
    from pyspark.sql import functions as F

    got = {(r.doc_id, r.text): r.p for r in L.language_id(docs, F.lit(learn) & F.col("doc_id").between(20, 100), name="p").collect()}
    assert got[1, None].lang_pred == got[2, ""].lang_pred == got[4, "12 34 !!"].lang_pred == "und"
    assert got[25, "der die das 5"].lang_pred == ("de" if learn else "und")


def test_kernel_equals_sets():
    a = L.Alphabet("abcdé")
    x, y = a.flags("ab, Éa"), a.flags("ba é")
    grams = lambda s: {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} - {" "}
    assert x.sum() == len(grams(" ab éa ")) and (x & y).sum() == len(grams(" ab éa ") & grams(" ba é "))
    assert a.flags("1 2") is None


def test_every_language_and_script():
    rng = random.Random(4)
    # 44 languages, each of eight letters of its own: 352 letters in five scripts.
    scripts = [0x3B1, 0x430, 0x5D0, 0x4E00, 0x20000]
    own = {f"l{n:02}": [chr(scripts[n % 5] + (8 * (n // 5) if n % 5 > 2 else 2 * (n // 5)) + j) for j in range(8)] for n in range(44)}
    text = lambda g: " ".join("".join(rng.choice(own[g]) for _ in range(5)) for _ in range(30))
    langs = [g for g in own for _ in range(6)]
    model = L.Model([text(g) for g in langs], langs)
    assert model.langs == sorted(own)
    assert np.mean([model.predict([text(g)])[0][0] == g for g in own]) >= 0.9


def test_languages_beyond_32_are_learned(spark):
    rows = [(f"{chr(0x4E00 + 9 * n)}{chr(0x4E01 + 9 * n)} {chr(0x4E02 + 9 * n)} {i}", f"l{n:02}") for n in range(40) for i in range(2)]
    assert len(L.learn_languages(spark.createDataFrame(rows, "text string, lang string")).langs) == 40
