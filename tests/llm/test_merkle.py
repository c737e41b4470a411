import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidepool.llm import merkle as M
from tidepool.llm import queries as Q
from tidepool.llm import sql

from .util import duck, spark_rows

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, at):
    """Root of ``nodes`` and the siblings (left, right) of node ``at`` on the way."""
    path = []
    while len(nodes) > 1:
        run = at // 16 * 16
        path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes, at = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return nodes[0], path


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
    subs = [climb([x[2] for x in groups[s]], 0)[0] for s in order]
    for i, s in enumerate(order):
        for j, (_, _, lf, r) in enumerate(groups[s]):
            path = climb([x[2] for x in groups[s]], j)[1] + climb(subs, i)[1]
            root, cur = climb(subs, 0)[0], lf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                cur = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                cur = h(left + cur + right)
            yield (r[0], lf, subs[i], root, h("".join(a + b for a, b in path)), cur, cur == root)


def test_query_equals_sql(spark):
    assert spark_rows(Q.op12_merkle_manifest(spark, SMALL)) == duck(sql.OP12, SMALL)


@pytest.mark.parametrize("shape", ["empty", "one", "odd", "hot", "hosts"])
def test_equals_plain_trees(spark, shape, tmp_path):
    rng = random.Random(shape)
    rows = []
    if shape == "one":
        rows = [(7, None, None, None, None)]
    if shape == "odd":
        rows = [(i if i % 9 else None, rng.choice([None, "", "b", "é", "\U0001f600"]), rng.choice([None, "de"]), rng.choice([None, -5, 0]), rng.choice([None, "", "ÀA b", "x" * 50_000]))
                for i in range(200)]
        rows += rows[:40] + rows[:3] * 20
    if shape == "hot":                      # three levels in one group, a lone leaf and a run of one beside it
        rows = [(i, "hot", "en", 1, f"Text {i}") for i in range(4097)] + [(i, "b", "en", 1, "T") for i in range(17)] + [(1, "lone", None, 2, "One")]
    if shape == "hosts":                    # the upper tree has three levels
        rows = [(i, f"h{i % 300}", "en", 1, f"Text {i}") for i in range(620)]
    rng.shuffle(rows)
    # other columns, also ones named like the operator's own
    spark.createDataFrame([(*r, i, "t", 0.0) for i, r in enumerate(rows)], SCHEMA + ", lo int, tree string, h double").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, Q.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(plain(rows), key=str)


def test_manifest_keeps_ranks_and_paths(spark):
    rows = [(i, "ab"[i % 2], None, i, "T") for i in range(100)]
    out = M.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).orderBy("lo").collect()
    assert [r.lo for r in out] == list(range(100)) and [r.source for r in out] == ["a"] * 50 + ["b"] * 50
    assert all(len(r.path) == 3 for r in out)
    other = spark.createDataFrame([tuple(out[3])], M.merkle_manifest(spark.createDataFrame(rows, SCHEMA)).schema)
    assert other.select(M.fold(F.col("leaf"), F.col("path"))).first()[0] == out[0].root
