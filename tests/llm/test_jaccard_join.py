import random
import re

import pytest

from tidepool.llm import jaccard_join as J
from tidepool.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = [(d, shingles(t, k)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)) and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min([x for x in (low.get(find(i)), d) if x is not None], default=None)
    return sorted(((d, len(s), low[find(i)] if s else d) for i, (d, s) in enumerate(sets)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_tables_equal_brute_force(spark):
    docs = read_table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(J.jaccard_components(docs, 4, 85, 100)) == brute(rows, 4, 85, 100)


@pytest.mark.parametrize("num", [85, 60])
def test_random_small_and_hot(spark, monkeypatch, num):
    monkeypatch.setattr(J, "LIST_PAIRS", 4)
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "FREQUENT", 6)
    rng = random.Random(num)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 7, 9, 15, 40, 60]))] for _ in range(6)]
    rows = []
    for i in range(220):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(3000)}"
        rows.append((i, " ".join(w + [f"t{rng.randrange(4)}"] * rng.randrange(2))))
    rows += [(None, rows[0][1]), (500, None), (501, ""), (502, " \n"), (3, rows[3][1]), (503, "Ä " * 3000)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n long_".replace("n long_", "id string"))
    assert got(J.jaccard_components(docs, 4, num, 100)) == brute(rows, 4, num, 100)
    kept = sorted(((r.doc_id, r.text, r.id) for r in J.one_per_group(docs, 4, num, 100).collect()), key=str)
    # documents are pairs of id and text, in order; each is a row of its own to the brute force
    pairs = sorted({(d is None, d or 0, t is None, t or "") for d, t in rows})
    named = [(i, None if p[2] else p[3]) for i, p in enumerate(pairs)]
    first = [i for i, n, c in brute(named, 4, num, 100) if i == c or not n]
    assert kept == sorted(((None if pairs[i][0] else pairs[i][1], named[i][1], "x") for i in first), key=str)


def test_documents_are_ids_and_texts(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "a b c d e f"), (1, text), (2, text + " more"), (None, text), (None, "q r s t u"), (None, "q r s t u"), (3, ""), (3, ""), (None, None), (4, "x y z")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, key int")
    out = J.one_per_group(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, "a b c d e f"), (1, text), (None, "q r s t u"), (3, ""), (3, ""), (None, None), (4, "x y z")], key=str)
    assert J.one_per_group(docs.limit(0)).count() == 0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert got(J.jaccard_components(docs)) == []


def test_light_boundary_follows_cost():
    assert J.light_boundary({7: 100}, 1.0, 85, 100) < 7 <= J.light_boundary({7: 100}, 50.0, 85, 100)
