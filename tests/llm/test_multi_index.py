import numpy as np
import pandas as pd
import pytest

from tidepool.llm import multi_index as M
from tidepool.llm import queries as Q
from tidepool.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def brute(rows, every, k):
    """Best ``k`` others of every query row by sums in order of the components."""
    rows = sorted({(i, tuple(np.float32(v))) for i, v in rows})
    for i, v in rows:
        if i % every == 0:
            s = [(-float(np.cumsum(np.array(v, float) * np.array(w, float))[-1]), j) for j, w in rows if j != i]
            yield from ((i, r, j, -t) for r, (t, j) in enumerate(sorted(s)[:k], 1))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    got = Q.op11_multi_index_search(spark, f"/root/testdata/{sf}").toPandas()
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, f"/root/testdata/{sf}", "embeddings").collect()]
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    found = 0
    for q, group in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -9
        group = group.sort_values("rank")
        assert list(group["rank"]) == list(range(1, 21)) and q not in set(group.vec_id) and group.vec_id.is_unique
        assert np.allclose(group.score, s[np.searchsorted(ids, group.vec_id)] if (np.diff(ids) > 0).all() else group.score, atol=1e-12)
        found += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(group.vec_id))
    assert found / len(got) >= 0.9 and len(got) == 20 * (ids % 20 == 0).sum()


@pytest.mark.parametrize("n", [0, 1, 5, 21, 300])
def test_odd_rows(spark, monkeypatch, n):
    monkeypatch.setattr(M, "ENTRIES", 64)
    monkeypatch.setattr(M, "QUERY_BLOCK", 4)
    monkeypatch.setattr(M, "KEPT", 1.0)
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + 9 * (i % 7 == 0))]) for i in range(n)]
    odd = []
    if n == 300:          # a third are copies; ids that repeat, with the same vector and with another
        rows += [(1000 + i, [0.5, 0.5, 0.25, 1.0, 0.0, 0.0]) for i in range(150)] + [rows[40], rows[40], (60, [1.0, 0.0, 0.0, 0.0, 0.0, -2.0])]
        odd = [(2000, None), (2020, []), (2040, [1.0, None, 0, 0, 0, 0]), (2060, [float("nan")] * 6), (2080, [float("inf")] * 6), (2100, [0.0] * 6), (2120, [1.0] * 5), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, [float(x) if x is not None else None for x in v] if v is not None else None, 1.0, 2) for i, v in rows + odd],
                               "vec_id long, embedding array<float>, score double, place int")
    got = M.nearest(df, lambda i: i % 20 == 0, k=7, bits=64)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    got, want = sorted(map(tuple, got.collect())), sorted(brute(rows, 20, 7))
    if n < 300:           # fewer rows than the radius is learned from: all are looked at
        assert got == want
    else:
        assert [g[:2] for g in got] == [w[:2] for w in want] and all(g[3] <= w[3] for g, w in zip(got, want, strict=True))
        assert len(set(got) & set(want)) >= 0.9 * len(want)


@pytest.mark.parametrize("radius", [-1 + 1, 3, 9, 20, 64])
def test_probing_finds_every_code(radius):
    rng = np.random.default_rng(radius)
    centre = rng.integers(0, 256, 8, dtype=np.uint8)
    codes = np.array([np.packbits(np.unpackbits(centre) ^ (rng.random(64) < rng.choice([0, 0.05, 0.2, 0.5]))) for _ in range(500)])
    places = np.sort(rng.choice(10_000, 500, replace=False))
    p = M.parts(codes)
    index = pd.DataFrame([(j, int(p[i, j]), codes[i].tobytes(), places[i]) for i in range(500) for j in range(4)], columns=["j", "value", "code", "place"])
    asked = pd.DataFrame({"query": [1, 2], "code": [centre.tobytes(), codes[7].tobytes()], "radius": radius})
    found = M._probe(4, 1000)(asked, index)
    for key, code in ((1, centre), (2, codes[7])):
        near = places[np.bitwise_count(codes ^ code).sum(axis=1) <= radius]
        mine = found[found["query"] == key]
        got = [h * 1000 + x for h, b in zip(mine["home"], mine.places, strict=True) for x in np.frombuffer(b, "<u4")]
        assert sorted(got) == sorted(near)          # all, and each once
    assert (M.allowed(radius, 4) + 1).sum() == radius + 1


def test_routes_reach_every_block():
    """Blocks left out hold no value within a substring's bound."""
    rng = np.random.default_rng(3)
    low = np.sort(rng.integers(0, 1 << 16, 40)).astype(np.uint16)
    high = np.concatenate([low[1:], [65535]]).astype(np.uint16)

    class Shared:
        value = (np.arange(40), np.zeros(40, int), low, high)

    import pyarrow as pa

    code = rng.integers(0, 256, 2, dtype=np.uint8)
    batch = pa.RecordBatch.from_pydict({"code": pa.array([code.tobytes()], pa.binary()), "radius": pa.array([2], pa.int32())})
    got = {b for out in M._routes(Shared, 1)([batch]) for b in out.column("block").to_pylist()}
    near = np.flatnonzero(np.bitwise_count(np.arange(1 << 16, dtype=np.uint16) ^ M.parts(code[None])[0, 0]) <= 2)
    assert {b for b in range(40) if ((near >= low[b]) & (near <= high[b])).any()} <= got and len(got) < 40


def test_radius_of_clusters(spark):
    """Tight clusters: the radius stays small and nothing is lost."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 32))
    x = (centres[:, None] + 0.15 * rng.normal(size=(60, 50, 32))).reshape(-1, 32)
    model = M.Codes(x[rng.permutation(3000)], np.sqrt((x * x).sum(axis=1)).max(), 128, 30 / 3000)
    assert model.first < 40
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = M.nearest(df, lambda i: i % 100 == 0).toPandas()
    want = {(i, j) for i in range(0, 3000, 100) for j in [j for j in np.argsort(-(x @ x[i]), kind="stable") if j != i][:20]}
    assert len(want & set(zip(got.query_id, got.vec_id, strict=True))) >= 0.95 * len(want)
