import math

import numpy as np
import pytest

from edgeweave.llm import graph_index, queries
from edgeweave.sources.derived import table
from pyspark.sql import functions as F


def plain_nearest(ids, vectors, query_ids, k=20):
    out = {}
    for q in query_ids:
        asks = vectors[ids == q][0]
        scores = np.einsum("nd,d->n", vectors, asks)
        keep = ids != q
        order = np.lexsort((ids[keep], -scores[keep]))[:k]
        out[q] = (ids[keep][order], scores[keep][order])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, rank int")


def searched(spark, rows, **options):
    found = {}
    for r in graph_index.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, **options).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in found.items()}


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    want = plain_nearest(ids, vectors, ids[ids % 20 == 0])
    got = {}
    for r in queries.op9_graph_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    recalls = []
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        for _, i, score in found:
            assert score == pytest.approx(vectors[ids == i][0] @ vectors[ids == q][0], abs=1e-12)
        recalls.append(len({f[1] for f in found} & set(want[q][0].tolist())) / 20)
    assert np.mean(recalls) >= 0.95


def test_lengths_differ_and_shards_are_many(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 1, (600, 12)) * rng.uniform(0.2, 3, (600, 1))
    ids = np.arange(600)
    got = searched(spark, list(zip(ids.tolist(), vectors.tolist())), shard_rows=150)
    want = plain_nearest(ids, vectors, ids[::20])
    hits = [len({i for _, i, _ in got[q]} & set(want[q][0].tolist())) for q in want]
    assert np.mean(hits) >= 19


def test_copies_are_one_node_and_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(500 + i, [float(i), 1.0, 0.0]) for i in range(1, 30)]
    got = searched(spark, rows, shard_rows=200)
    want = plain_nearest(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [0, 20, 40])
    for q in (0, 20, 40):
        assert [i for _, i, _ in got[q]] == want[q][0].tolist()


def test_few_rows_and_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0]), (None, [1.0, 1.0]), (3, None), (4, [])]
    rows += [(5, [0.0, 0.0]), (6, [None, 1.0]), (7, [math.nan, 1.0]), (8, [math.inf, 1.0]), (20, [0.0, 0.0])]
    got = searched(spark, rows)
    assert got == {0: [(1, 1, 0.5), (2, 2, -1.0), (3, 2, -1.0)]}
    assert searched(spark, [(0, [1.0])]) == {}
    assert graph_index.nearest(frame(spark, rows).limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_pruned_edges_are_diverse():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [0, 1.1]], np.float32)
    out = graph_index.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, -1]]), 1.2, 4)
    assert sorted(out[0][out[0] >= 0].tolist()) == [1, 3]
