import math
import random

import numpy as np
import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import queries, topk
from pyspark.sql import functions as F


def plain_top(rows, k=20):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in whole if i % 20 == 0}:
        asks = min(v for i, v in whole if i == q)
        found = sorted((-sum(a * b for a, b in zip(asks, v)), i) for i, v in whole if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.5) for i, v in rows], "vec_id long, embedding array<double>, score double")


def got(spark, rows):
    return sorted(tuple(r) for r in topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())


@pytest.mark.parametrize("cells", [16384, 40])
def test_matches_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(topk, "CELL_ROWS", cells)
    monkeypatch.setattr(topk, "QUERY_ROWS", cells // 8)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.1, rng.gauss(0, 0.3)]) for _ in range(19)]) for i in range(300)]
    rows += [rows[5], rows[5], rows[40], (20, rows[3][1]), (None, rows[0][1]), (301, None), (302, []), (303, [None] + [0.1] * 18)]
    rows += [(304, [math.nan] * 19), (305, [math.inf] * 19), (320, [0.0] * 19), (-20, [5.0] * 19)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    assert got(spark, rows) == plain_top(rows)


def test_huge_components(spark):
    rows = [(0, [2.0**37, 1.0]), (1, [2.0**12, 0.5]), (2, [-(2.0**12), 7.0]), (3, [1.0, -1.0])]
    assert got(spark, rows) == plain_top(rows)
    with pytest.raises(Exception, match="63 bits"):
        got(spark, [(0, [1e300, 1.0]), (1, [1e300, 1.0])])


def test_few_and_none(spark):
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert topk.top_k(frame(spark, [(0, [1.0])]).limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_bounds_drop_candidates_but_not_results():
    rng = np.random.default_rng(1)
    columns = np.floor(rng.normal(0, 8, (64, 5000)) * np.linspace(3, 0.1, 64)[:, None])
    query = np.floor(rng.normal(0, 8, 64) * np.linspace(3, 0.1, 64))
    lengths = np.sqrt(np.vstack([np.cumsum((columns**2)[::-1], axis=0)[::-1], np.zeros(5000)]))
    near, scores = topk.branch_and_bound(query, -1, np.arange(5000), columns, lengths, -np.inf, 20)
    exact = query @ columns
    assert len(near) < 1000 and (exact[near] == scores).all()
    assert set(np.argsort(-exact)[:20]) <= set(near.tolist())


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    name = "op1_exact_top_k"
    assert spark_bag(queries.queries()[name](spark, sf)) == sql_bag(connect(sf), queries.oracle_sql()[name])
