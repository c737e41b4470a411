from tidepool.llm import license_scan as L
from tidepool.llm import queries as Q
from tidepool.sources.tables import read_table

SF = "/root/testdata/sf0.01"
NOTICES = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL",
           "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved.": "proprietary"}


def test_documents(spark):
    text = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    rows = Q.op1_license_scan(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = {f for n, f in NOTICES.items() if any(x.strip() == n for x in (text[r.doc_id] or "").split("\n"))}
        assert want <= set(r.families), (r, want)
        assert set(r.families) - {"unknown"} <= want, (r, want)
    assert sum(r.license == "unknown" for r in rows) <= 0.01 * len(rows)


def test_held_out_notices(spark):
    docs = read_table(spark, SF, "documents", ["text"])
    new = [("Licensed under the Apache License 2.0 by us", "Apache-2.0"), ("Files here are released under the MIT License today.", "MIT"),
           ("you can redistribute it and/or modify it under the terms of the GNU General Public License", "GPL"), ("the cat sat on the mat", "none"),
           ("Licensed under the Foo Bar Public Terms License, version 9.", "unknown"), (None, "none"), ("", "none"), (" \n ", "none"), ("word " * 50000, "none")]
    table = spark.createDataFrame([(t, "s") for t, _ in new] + [(new[0][0], "s")] * 2, "text string, license string")
    model = spark.sparkContext.broadcast(L.train(docs))
    got = {r.text: r.found for r in table.withColumn("found", L._scan_udf(model)("text")).collect()}
    for t, want in new:
        assert got[t].license == want, (t, got[t])
    assert got[None].n_paragraphs == got[""].n_paragraphs == 0
    assert L.license_scan(table.limit(0), name="x").count() == 0
    assert L.license_scan(table, name="x").count() == len(new) + 2


def test_negatives_do_not_depend_on_batches(spark):
    words = "alpha beta gamma delta".split()
    rows = [("\n".join(f"{words[j % 4]} {i} {j}" for j in range(i % 9)),) for i in range(60)] + [(None,), ("",), ("same line\nsame line",)] * 2
    docs = spark.createDataFrame(rows, "text string")
    want = [w.tolist() for w in L.negatives(docs, sample_docs=1000)]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert [w.tolist() for w in L.negatives(docs.repartition(5), sample_docs=1000)] == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert len(want) == sum(min(len(set(t.splitlines())), L.PARAGRAPHS) for t in {t for t, in rows if t})
