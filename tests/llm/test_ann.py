import numpy as np
import pytest
from pyspark.sql import functions as F
from regpanel.llm import op10_ann


def brute(ids, v, queries, k):
    out = {}
    for q in queries:
        score = (v * v[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def frame(spark, ids, v):
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, v)], "vec_id long, embedding array<double>")


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall_against_brute_force(spark, monkeypatch, unit):
    monkeypatch.setattr(op10_ann, "SHARD_ROWS", 1500)
    monkeypatch.setattr(op10_ann, "QUERY_ROWS", 100)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if not unit:
        v *= rng.uniform(0.8, 1.2, size=(4000, 1))
    ids = np.arange(4000)
    got = found(op10_ann.neighbours(frame(spark, ids, v), F.col("vec_id") % 20 == 0))
    want = brute(ids, v, range(0, 4000, 20), 20)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9, recall
    for q in list(want)[:20]:
        scores = dict(want[q])
        assert all(abs(scores[i] - s) < 1e-12 for i, s in got[q] if i in scores)


@pytest.mark.parametrize("size", [60, 150, 300, 500, 800, 2000])
def test_recall_of_the_index_at_any_size(spark, size):
    # The driver's vectors; a size under a shard's is searched by the same index.
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where(F.col("vec_id") < size)
    rows = df.toPandas()
    want = brute(rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), dtype=np.float64), rows.vec_id[rows.vec_id % 20 == 0], 20)
    got = found(op10_ann.neighbours(df, F.col("vec_id") % 20 == 0))
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9, recall


def test_ties_copies_and_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([np.tile(rng.normal(size=8), (300, 1)), rng.normal(size=(60, 8)) * 0.1])
    ids = np.arange(360)
    got = found(op10_ann.neighbours(frame(spark, ids, v), F.col("vec_id") == 20, 5))
    assert [i for i, _ in got[20]] == [0, 1, 2, 3, 4]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (20, [0.0, 1.0], 1), (8, [], 1), (9, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = found(op10_ann.neighbours(df, F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: [1, 20, 9], 20: [1, 0, 9]}
    assert op10_ann.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
