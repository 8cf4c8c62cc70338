import numpy as np
from pyspark.sql import functions as F

from renewlens.llm import ann


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    keep = ids != q
    order = np.lexsort((ids[keep], d[keep]))[:k]
    return list(zip(ids[keep][order].tolist(), d[keep][order].tolist()))


def test_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 12)) + rng.normal(size=(6, 12))[rng.integers(0, 6, 3000)] * 2
    x[1000:1900] = x[1000]  # many equal vectors
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 0, i) for i, v in enumerate(x)]
    rows += [(9000, None, 0, 1), (9100, [0.0] * 12, 0, 1), (9200, [float("nan")] * 12, 0, 1), (9300, [None] + [1.0] * 11, 0, 1), (9400, [], 0, 1), (9500, [1.0, 2.0], 0, 1), (9600, [float("inf")] * 12, 0, 1), (None, [1.0] * 12, 0, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, tree long")
    got = ann.search(df, F.col("vec_id") % 100 == 0, k=10, leaf_rows=200, chunk_rows=150).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    ids = np.arange(3000)
    hits = total = 0
    for q in range(0, 3000, 100):
        want = brute(ids, x, q, 10)
        assert [r for *_, r in found[q]] == list(range(1, 11))
        hits += len({v for v, _ in want} & {v for v, *_ in found[q]})
        total += 10
        for v, s, _ in found[q]:
            assert s == np.sqrt(((x[v] - x[q]) ** 2).sum())
    assert set(found) == set(range(0, 3000, 100)) and hits / total >= 0.9
    assert [v for v, *_ in found[1500]] == list(range(1000, 1010))


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0, 0.0]), (2, [4.0, 0.0])], schema)
    got = ann.search(df, F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1, 1.0), (0, 2, 2, 3.0)]
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") == 0).collect() == []


def test_probing_all_leaves_finds_all():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5))
    forest = [ann.grow(x, 10, rng) for _ in range(2)]
    for t in forest:
        assert set(t.leaf_of(x)) == set(range(t.leaves))
    got = ann.probe(forest, x[0], 10**6)
    assert len(got) == len(set(got)) == sum(t.leaves for t in forest)
    assert got[0][1] == forest[got[0][0]].leaf_of(x[:1])[0]
