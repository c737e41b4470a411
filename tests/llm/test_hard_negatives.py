import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import hard_negatives as H
from tidepool.llm import queries as Q
from tidepool.llm import sql
from tidepool.session import scratch_path

from .util import duck, spark_rows

SMALL = "/root/testdata/sf0.001"


def small_blocks(monkeypatch):
    for name, n in (("CLUSTER", 4), ("BLOCK", 32), ("SLAB", 8), ("FIRST", 1), ("GROWTH", 2)):
        monkeypatch.setattr(H, name, n)


def test_query_equals_sql(spark):
    assert spark_rows(Q.op13_hard_negatives(spark, SMALL)) == duck(sql.OP13, SMALL)


@pytest.mark.parametrize("shape", ["empty", "one", "few", "odd"])
def test_odd_rows(spark, monkeypatch, tmp_path, shape):
    small_blocks(monkeypatch)
    rng = np.random.default_rng(4)
    n = {"empty": 0, "one": 1, "few": 9, "odd": 500}[shape]
    rows = [(i * (1 if shape == "odd" else 10), [float(x) for x in rng.integers(-4, 5, 4) / 8], int(rng.integers(0, 4))) for i in range(n)]
    if shape == "odd":      # a third are copies; repeated rows and ids; zeros, nulls, wrong lengths
        rows += [(1000 + i, [0.25, 0.25, 0.25, 0.5], i % 2) for i in range(260)] + [rows[100], rows[100], (150, [1.0, 0.5, 0.0, 0.0], 3), (200, [0.0] * 4, 1), (250, [0.0] * 4, 2)]
        rows += [(2000, None, 1), (2050, [1.0, None, 2.0, 3.0], 1), (2100, [float("nan")] + [1.0] * 3, 1), (None, [1.0] * 4, 1), (2150, [1.0] * 4, None), (2200, [float("inf")] * 4, 1), (2250, [], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame([(*r, 0, "x") for r in rows], schema + ", place int, wants string").write.parquet(f"{tmp_path}/embeddings.parquet")
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32())})
    assert spark_rows(Q.op13_hard_negatives(spark, str(tmp_path))) == duck(sql.OP13, embeddings=table)


def test_other_lengths_and_large_components_take_no_part(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.6, 0.0], 2), (3, [1.0, 0.0, 0.0], 2), (4, [1e9, 0.0], 2), (50, [0.9, 0.0], 1)]
    got = H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), lambda i: i == 0)
    assert [tuple(r) for r in got.orderBy("positive_id").collect()] == [(0, 1, 1, 2, 65536, 39168), (0, 50, 1, 2, 58880, 39168)]


def test_large_scores_stay_exact(spark):
    """Scores beyond 2**53 are integer sums."""
    big = float(2**24 - 1) / 256
    rows = [(0, [big] * 64, "a"), (1, [big] * 64, "a"), (2, [big] * 63 + [big - 1 / 256], "a"), (3, [big] * 32 + [0.0] * 32, "b"), (4, [big] * 32 + [1 / 256] + [0.0] * 31, "b")]
    got = H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), lambda i: i == 0, positives=1)
    m = 2**24 - 1
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 4, 64 * m * m, 32 * m * m + m), (0, 1, 2, 3, 64 * m * m, 32 * m * m)]


def test_walk_ends_early_on_clusters(spark, monkeypatch):
    """Anchors of tight clusters read a small part of all blocks, and the result is whole."""
    small_blocks(monkeypatch)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    x = np.concatenate([c + 0.1 * rng.normal(size=(300, 16)) for c in centres])
    rows = [(i, [float(v) for v in x[i]], i % 2) for i in range(len(x))]
    walked = []
    kept = H.written

    def count(df, label):
        out = kept(df, label)
        if label in ("asked", "lists"):
            walked.append((label, out.count() if label == "lists" else out.select("cluster", "block").distinct().count()))
        return out

    monkeypatch.setattr(H, "written", count)
    path = scratch_path(spark, "clusters")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32())})
    assert spark_rows(Q.op13_hard_negatives(spark, path)) == duck(sql.OP13, embeddings=table)
    pairs = sum(n for label, n in walked if label == "lists")
    read = sum(n for label, n in walked if label == "asked")
    assert read < 0.5 * 2 * pairs, (read, pairs)          # two walks


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) * rng.exponential(size=(300, 1))
    q = rng.normal(size=(7, 5)) + 2
    centre = H.fit_centres(q, 1)
    norm, angle = H.angles(x, centre)
    size, turn = H.angles(q, centre)
    bound = norm * np.cos(np.maximum(0, np.maximum(angle[:, 0] - turn.max(), turn.min() - angle[:, 0])))
    assert (q @ x.T <= size[:, None] * bound + 1e-9).all()
