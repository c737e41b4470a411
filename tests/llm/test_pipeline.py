"""The corpus pipeline's stages, one after the other, on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tidepool.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def tables(spark, path, docs, labels, items, extra=""):
    rows = [(*d, i, "x") for i, d in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, toxicity string" + extra).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def steps(spark, path):
    docs = read_table(spark, path, "documents")
    yield "input", docs.collect(), docs.columns
    for name, stage in P.STAGES:
        docs = stage(spark, docs, path)
        yield name, docs.collect(), docs.columns
        if name != P.STAGES[-1][0]:
            docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_stages_on_planted_cases(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    prose = lambda n=60: " ".join(rng.choice(words) for _ in range(n))
    item = prose(40)
    docs, labels = [], []

    def add(text, doc_id=None, source="s", null=False):
        docs.append((None if null else len(docs) if doc_id is None else doc_id, text, "en", source, len(text or "")))
        return len(docs) - 1

    for i in range(120):
        add(f"Read more on our site\n{prose()}")
    toxic = [add(prose(30) + " idiot trash idiot " + prose(5)) for _ in range(40)]
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(i, 0, 1) for i in toxic[::2]]
    base = prose(200)
    copies = [add(base), add(base), add(base + " tail"), add(base, null=True)]
    leak = add(prose(20) + " " + item)
    clash = [add(prose(), doc_id=5000), add(prose(), doc_id=5000)]
    blank = [add(""), add(None), add(" ", null=True)]
    tables(spark, str(tmp_path), docs, labels, [(1, item), (2, prose(30)), (None, prose(30))])
    at = {}
    for name, rows, columns in steps(spark, str(tmp_path)):
        at[name] = {r.key for r in rows} if "key" in columns else rows
        if name == "input":
            names = columns
        elif name != "mixing sources":
            assert columns == names
        if name == "line dedup":
            assert not any("Read more" in (r.text or "") for r in rows) and all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert at["input"] - at["toxicity"] == set(toxic)
    assert at["line dedup"] == at["toxicity"]
    assert at["line dedup"] - at["near duplicates"] == set(copies[1:])
    assert at["near duplicates"] - at["benchmark decontamination"] == {leak}
    last = at["mixing sources"]
    assert len(last) == len(at["benchmark decontamination"]) and set(clash + blank) <= at["benchmark decontamination"]
    assert sum(r.taken for r in last) > sum(r.size for r in last)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, empty):
    docs = [] if empty == "documents" else [(1, "a b c d e", "en", None, 9), (2, "f g h i j", None, "s", 9), (2, "f g h i j", None, "s", 9)]
    labels = [] if empty == "labels" else [(1, 1, 0), (2, 1, 1)]
    items = [] if empty == "benchmark" else [(1, "x y z u v w")]
    tables(spark, str(tmp_path), docs, labels, items)
    sizes = [len(rows) for _, rows, _ in steps(spark, str(tmp_path))]
    assert sizes[0] == len(docs) and (sizes[-1] == 0 if empty == "documents" else sizes[-1] >= 1)


def test_run_equals_its_stages(spark):
    docs = read_table(spark, SMALL, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SMALL)
    out = P.run(spark, SMALL)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert out.agg(F.count("*")).first()[0] > 100
