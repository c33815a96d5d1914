"""Exact top-k search by integer inner product: columnar branch and bound.

**Layout.** Each component ``x`` becomes ``floor(scale * x)``. Queries and candidates meet in a grid of
cells: a cell has at most about ``QUERY_ROWS`` queries, which it holds, and about ``CELL_ROWS``
candidates, which pass by in blocks stored dimension by dimension (one contiguous run per
dimension). No pair of vectors is ever a row of a table.

**Branch and bound.** Within a block a query adds up its products dimension block by dimension block,
the dimensions largest in the queries first. After each, a candidate can gain at most the product
of the two lengths left in the remaining dimensions (its remaining mass). Candidates whose sum plus
that bound is below the floor are dropped and the survivors compacted; the floor is the k-th best
score so far in the cell or, if higher, the k-th best of the block's lower bounds. What survives all
dimensions has its exact score. A cell returns at most k rows per query, and no candidate of the
final k is ever dropped, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.session import cut_lineage

SCALE, K = 64, 20
QUERY_ROWS, CELL_ROWS, STEP = 16384, 16384, 8
LIMIT = 2.0**53


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<double>)`` of scaled components; rows that take no part are left out.

    Those are rows with a null id, a null or empty vector, or a null or non-finite component.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & (F.size(x) > 0) & ~bad)
    # doubles, as the floor of a large component is no long
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: _floor(c * scale)).alias("v"))


def _floor(x: Column) -> Column:
    whole = F.floor(F.greatest(F.least(x, F.lit(2.0**62)), F.lit(-(2.0**62)))).cast("double")
    return F.when(F.abs(x) < 2.0**62, whole).otherwise(x)


def _matrix(column: pa.Array) -> np.ndarray:
    widths = np.diff(column.offsets.to_numpy())
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors of different lengths")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(widths), -1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, then smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def branch_and_bound(
    query: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, lengths: np.ndarray, floor: float, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the candidates that may be among the k best at or above ``floor``.

    ``lengths[d]`` is each candidate's length in the dimensions from ``d`` on, in the order given.
    """
    if np.sqrt(query @ query) * lengths[0].max(initial=0) >= LIMIT:  # too large for exact doubles
        near = np.flatnonzero(ids != own)
        scores = [sum(int(a) * int(b) for a, b in zip(query, c)) for c in columns.T[near]]
        if max(map(abs, scores), default=0) >= 1 << 63:
            raise OverflowError("a score exceeds 63 bits")
        return ids[near], np.array(scores, np.int64)
    alive = np.flatnonzero(ids != own)
    sums = np.zeros(len(alive))
    rest = np.sqrt(np.concatenate((np.cumsum((query * query)[::-1])[::-1], [0])))
    whole = len(alive) == columns.shape[1]
    for at in range(0, len(query), STEP):
        part = columns[at : at + STEP] if whole else columns[at : at + STEP, alive]
        sums = sums + query[at : at + STEP] @ part
        end = min(at + STEP, len(query))
        gain = rest[end] * lengths[end][alive]
        if end < len(query):
            floor = max(floor, _kth(sums - gain, k))
        keep = sums + gain * (1 + 1e-9) + 1e-6 >= floor  # a margin for rounding in the lengths
        if keep.sum() < len(alive):
            alive, sums, whole = alive[keep], sums[keep], False
    return ids[alive], sums.astype(np.int64)


class _Cell:
    """The queries of one cell with the best candidates seen so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int) -> None:
        self.ids, self.matrix, self.k = ids, matrix, k
        self.order = np.argsort(-np.abs(matrix).mean(axis=0), kind="stable") if len(ids) else None
        self.near = [np.zeros(0, np.int64) for _ in ids]
        self.scores = [np.zeros(0, np.int64) for _ in ids]

    def see(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        if not len(self.ids):
            return
        if matrix.shape[1] != self.matrix.shape[1]:
            raise ValueError("vectors of different lengths")
        columns = np.ascontiguousarray(matrix.T[self.order])
        tails = np.cumsum((columns * columns)[::-1], axis=0)[::-1]
        lengths = np.sqrt(np.vstack([tails, np.zeros(len(ids))]))
        for i, query in enumerate(self.matrix[:, self.order]):
            floor = float(self.scores[i][-1]) if len(self.scores[i]) == self.k else -np.inf
            near, scores = branch_and_bound(query, self.ids[i], ids, columns, lengths, floor, self.k)
            near, scores = np.concatenate((self.near[i], near)), np.concatenate((self.scores[i], scores))
            best = _best(scores, near, self.k)
            self.near[i], self.scores[i] = near[best], scores[best]

    def found(self) -> pa.RecordBatch:
        counts = [len(n) for n in self.near]
        empty = np.zeros(0, np.int64)
        columns = (np.repeat(self.ids, counts), np.concatenate([empty, *self.near]), np.concatenate([empty, *self.scores]))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def _search(k: int):
    """Over rows sorted by cell, a cell's queries first: search each cell as its candidates pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell, asked = None, None, []

        def opened() -> _Cell:
            ids = np.concatenate([np.zeros(0, np.int64)] + [i for i, _ in asked])
            return _Cell(ids, np.concatenate([m for _, m in asked]) if asked else np.zeros((0, 0)), k)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            kinds = batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)]):
                part = batch.slice(a, b - a)
                ids, matrix = part.column("vec_id").to_numpy(), _matrix(part.column("v"))
                if cells[a] != now:
                    if cell is not None:
                        yield cell.found()
                    now, cell, asked = cells[a], None, []
                if kinds[a] == 0:
                    asked.append((ids, matrix))
                else:
                    cell = cell or opened()
                    cell.see(ids, matrix)
        if cell is not None:
            yield cell.found()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k candidates with the highest integer inner product.

    Queries are the rows that ``is_query`` selects, candidates all rows but those with the query's
    own id; fewer than k candidates are all returned, ties go to the smaller id. A repeated row is a
    candidate as often as it stands there; of several rows with one query id the least vector asks.
    An empty table gives no rows, columns beyond ``vec_id`` and ``embedding`` are ignored, vectors of
    different lengths and scores beyond 63 bits are errors.
    """
    whole = cut_lineage(whole_vectors(vectors.select("vec_id", "embedding"), scale))
    asked = whole.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = whole.agg(F.count(F.lit(1)), F.count_distinct(F.when(is_query, F.col("vec_id")))).first()
    across, down = max(1, -(-sizes[0] // CELL_ROWS)), max(1, -(-sizes[1] // QUERY_ROWS))

    def placed(rows: DataFrame, kind: int, column: Column, row: Column) -> DataFrame:
        return rows.select((row * across + column).alias("cell"), F.lit(kind).alias("kind"), "vec_id", "v")

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = asked.withColumn("column", every(across))
    queries = placed(queries, 0, F.col("column"), F.pmod(F.xxhash64("vec_id"), F.lit(down)))
    candidates = whole.withColumn("row", every(down))
    candidates = placed(candidates, 1, F.pmod(F.monotonically_increasing_id(), F.lit(across)), F.col("row"))
    met = queries.unionByName(candidates).repartition(across * down, "cell").sortWithinPartitions("cell", "kind")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: DuckDB SQL for the 20 best of every vector whose id is divisible by 20, over ``embeddings``.
TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT vec_id, min(v) AS v FROM whole WHERE vec_id % 20 = 0 GROUP BY vec_id) q
  JOIN whole c ON q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS "rank", vec_id, score FROM ranked WHERE place <= 20
"""
