from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import ONE_LINE, SOLILOQUY, WINDOW_WORDS
from tidepool.operators.count_window import count_window
from tidepool.operators.rolling import keyed_totals, rolling_sum
from tidepool.operators.tokenize import tokenize_whitespace, tokenize_words
from tidepool.sources.records import from_elements, from_tuples


def lines(spark, values):
    return from_elements(spark, values).withColumnRenamed("seq", "doc_id")


def test_soliloquy_word_count(spark):
    toks = tokenize_words(lines(spark, SOLILOQUY))
    assert toks.count() == 287
    counts = {r.word: r.n for r in keyed_totals(toks, ["word"]).collect()}
    assert len(counts) == 170
    for w, n in {"the": 22, "to": 15, "of": 15, "and": 12, "that": 7, "a": 5, "s": 5, "sleep": 5}.items():
        assert counts[w] == n


def test_rolling_is_one_row_per_token_and_ends_at_total(spark):
    docs = lines(spark, SOLILOQUY)
    roll = rolling_sum(tokenize_words(docs), ["word"], ["doc_id", "pos"], n_blocks=7, block_source=docs)
    rows = roll.collect()
    assert len(rows) == 287
    last = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.pos)):
        assert r.n == last.get(r.word, 0) + 1
        last[r.word] = r.n
    assert last["the"] == 22


@pytest.mark.parametrize("n_blocks", [1, 3, 50])
def test_count_window_10_5(spark, n_blocks):
    docs = lines(spark, SOLILOQUY)
    out = count_window(tokenize_words(docs), ["word"], ["doc_id", "pos"], 10, 5, n_blocks=n_blocks,
                       block_source=docs).collect()
    counts = Counter(r.word for r in tokenize_words(docs).collect())
    assert len(out) == sum(n // 5 for n in counts.values()) == 16
    assert all(r.n == min(r.seq_in_key, 10) for r in out)


def test_count_window_one_line_emits_nothing(spark):
    docs = lines(spark, ONE_LINE)
    assert count_window(tokenize_words(docs), ["word"], ["doc_id", "pos"], 10, 5).count() == 0


def test_count_window_6_1_window_words(spark):
    docs = lines(spark, WINDOW_WORDS)
    out = count_window(tokenize_words(docs), ["word"], ["doc_id", "pos"], 6, 1).collect()
    assert len(out) == 24
    by = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.pos)):
        by.setdefault(r.word, []).append(r.n)
    assert by["hello"] == [1, 2, 3]
    assert by["you"] == [1, 2]
    assert by["bytedance"] == [1, 2, 3, 4, 5]
    assert by["xiaomi"] == [1]


def test_count_window_value_path_matches_count_path(spark):
    docs = lines(spark, SOLILOQUY * 3)
    toks = tokenize_words(docs)
    a = count_window(toks, ["word"], ["doc_id", "pos"], 7, 3, n_blocks=5, block_source=docs)
    b = count_window(toks, ["word"], ["doc_id", "pos"], 7, 3, F.lit(1).cast("long"), n_blocks=5,
                     block_source=docs)
    assert sorted(a.collect()) == sorted(b.collect())


def test_token_edges(spark):
    df = lines(spark, [" To be,--É naïve x_1 "])
    assert [r.word for r in tokenize_words(df).orderBy("pos").collect()] == ["to", "be", "na", "ve", "x_1"]
    ws = [r.word for r in tokenize_whitespace(df).orderBy("pos").collect()]
    assert ws == ["to", "be,--é", "naïve", "x_1"]


def test_whitespace_tokens_strip_vertical_tab(spark):
    df = lines(spark, ["a\x0bb  C\td"])
    assert [r.word for r in tokenize_whitespace(df).orderBy("pos").collect()] == ["ab", "c", "d"]


@pytest.mark.parametrize("size,slide", [(7, 3), (40, 2), (3, 5)])
def test_count_window_prefix_plan_matches_expand_plan(spark, size, slide):
    import random

    from tidepool.sources.records import from_tuples

    rnd = random.Random(size * 100 + slide)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(5)}", i, rnd.randrange(-50, 100))
            for i in range(1500)]
    df = from_tuples(spark, rows, "key string, o long, v long")
    a = count_window(df, ["key"], ["o"], size, slide, F.col("v"), n_blocks=9, strategy="expand")
    b = count_window(df, ["key"], ["o"], size, slide, F.col("v"), n_blocks=9, strategy="prefix")
    c = count_window(df, ["key"], ["o"], size, slide, F.col("v").cast("decimal(10,2)"), n_blocks=4,
                     strategy="prefix")
    ea = sorted(tuple(r) for r in a.collect())
    assert ea == sorted(tuple(r) for r in b.collect())
    assert [(k, o, s, float(n)) for k, o, s, n in ea] == \
        sorted((r[0], r[1], r[2], float(r[3])) for r in c.collect())
    # brute force for the hot key
    hot = [v for k, _, v in rows if k == "hot"]
    exp = [(i + 1, sum(hot[max(0, i + 1 - size):i + 1])) for i in range(len(hot)) if (i + 1) % slide == 0]
    assert [(s, n) for k, _, s, n in ea if k == "hot"] == sorted(exp)


def test_count_window_plans_agree_on_nulls_and_types(spark):
    rows = [("a", i, None if i < 7 else i) for i in range(20)] + [("b", i, None) for i in range(6)]
    for kind in ("int", "bigint", "decimal(10,2)"):
        df = from_tuples(spark, rows, "key string, o long, v long").withColumn("v", F.col("v").cast(kind))
        a, b = (count_window(df, ["key"], ["o"], 5, 2, F.col("v"), n_blocks=4, strategy=s)
                for s in ("expand", "prefix"))
        assert a.schema["n"].dataType == b.schema["n"].dataType
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert [r.n for r in b.where("key = 'b'").collect()] == [None] * 3
