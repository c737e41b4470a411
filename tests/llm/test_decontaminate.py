import random
import re

from tidepool.llm import decontaminate as D
from tidepool.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def toks(t):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, item, m):
    """Textbook greedy string tiling over words."""
    a, b = toks(item), toks(text)
    if not a:
        return 0.0
    m = min(m, len(a))
    ma, mb = [False] * len(a), [False] * len(b)
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < m:
            return sum(ma) / len(a)
        for x in range(n):
            ma[i + x] = mb[j + x] = True


def test_tiles_equal_textbook():
    rng = random.Random(5)
    for _ in range(120):
        item = [rng.choice("abcdef") for _ in range(rng.randrange(1, 18))]
        text = [rng.choice("abcdef") for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.7:
            text += item[len(item) // 2 :] + ["x"] + item[: len(item) // 2]
        got = D.Items([(7, " ".join(item))], 3).coverages(D._word_hashes(" ".join(text)))
        assert (got[0][1] if got else 0.0) == brute(" ".join(text), " ".join(item), 3)


def test_table(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_BLOCK_WORDS", 400)
    items = read_table(spark, SMALL, "benchmark")
    rows = {r.item_id: r.text for r in items.collect()}
    w = toks(rows[1])
    cases = [(1, "x y " + rows[0].upper() + " z"), (2, " ".join(w[len(w) // 2 :] + ["und"] + w[: len(w) // 2])), (3, "the of and to in"), (4, None), (5, ""),
             (6, " ".join(w[: len(w) // 3])), (None, rows[2]), (1, "x y " + rows[0].upper() + " z"), (8, "word " * 30000 + rows[3])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in cases], "doc_id long, text string, coverage int")
    got = D.contamination(docs, items)
    assert got.columns == ["doc_id", "text", "coverage", "leak"]
    by = [(r.doc_id, r.leak.contaminated, r.leak.items) for r in got.collect()]
    assert [x[1] for x in by] == [True, True, False, False, False, False, True, True, True]
    assert 0 in by[0][2] and 1 in by[1][2] and 2 in by[6][2] and 3 in by[8][2]
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert D.drop_contaminated(docs.limit(0), items).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == len(cases)


def test_documents_equal_brute_force(spark):
    items = read_table(spark, SMALL, "benchmark")
    docs = read_table(spark, SMALL, "documents")
    grams = {}
    for r in items.collect():
        t = toks(r.text)
        for i in range(len(t) - 4):
            grams.setdefault(tuple(t[i : i + 5]), set()).add(r.item_id)
    texts = {r.item_id: r.text for r in items.collect()}
    for r in D.contamination(docs, items).collect():
        t = toks(r.text)
        meet = set().union(*[grams.get(tuple(t[i : i + 5]), ()) for i in range(len(t) - 4)]) if len(t) > 4 else set()
        assert r.leak.contaminated == any(brute(r.text, texts[i], 5) >= 0.6 for i in meet)


def test_items_without_id(spark, monkeypatch):
    items = spark.createDataFrame([(None, "one two three four five six"), (3, "red green blue black white pink"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three four five six y"), (2, "red green blue black white pink one two three four five six"), (4, "none of it")], "doc_id long, text string")
    for most in (1_000_000, 4):
        monkeypatch.setattr(D, "MAX_BLOCK_WORDS", most)
        got = {r.doc_id: (r.leak.contaminated, r.leak.item_id, r.leak["items"]) for r in D.contamination(docs, items).collect()}
        assert got == {1: (True, None, [None]), 2: (True, 3, [3, None]), 4: (False, None, [])}
        assert [r.doc_id for r in D.drop_contaminated(docs, items).collect()] == [4]
