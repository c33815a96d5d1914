"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one per shard.

**Index.** Rows are dealt to shards of about ``shard_rows``. In a shard equal vectors are one node that
lists their ids, so any number of copies costs one node. One more dimension makes all vectors
equally long (``sqrt(longest ** 2 - length ** 2)``), which turns the largest inner product into the
least distance. Nodes begin with random neighbours. Then, in batches and twice over, a greedy
search from the entry proposes the nodes near each node; robust pruning walks them from the nearest
on and keeps one unless a kept one is, by the factor ``alpha``, nearer to it than the node itself;
kept edges get a reverse edge, and nodes with too many edges are pruned again. Every row is in the
index, nothing is sampled. Nodes the entry does not reach get entries of their own.

**Search.** Every query visits every shard by beam search with ``beam`` nodes, the nodes found are scored
in double precision on the original vectors, and the shards' k best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.session import cut_lineage

K, SHARD_ROWS, DEGREE, BUILD_BEAM, BEAM, ALPHA = 20, 4096, 32, 64, 96, 1.2
BATCH, AT_ONCE, QUERY_ROWS, SEED = 256, 4, 16384, 5


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v array<double>)``; rows with a null id, or a vector that is null, empty, zero or
    has a null or non-finite component, take no part."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & ~bad & F.exists(x, lambda c: c != 0))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    widths = np.diff(column.offsets.to_numpy())
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(widths), -1)


def _squares(a: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", a, a)


def beam_search(
    points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes in its beam and their squared distances, nearest first (-1 fills up).

    The beam's ``AT_ONCE`` nearest nodes not yet expanded are expanded together, until none is left.
    """
    count = len(queries)
    lengths = _squares(points)
    seen = np.zeros((count, len(points) + 1), bool)
    seen[:, -1] = True  # stands for "no edge"
    rows = np.arange(count)
    nodes = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf, np.float32)
    done = np.ones((count, beam), bool)

    def enter(at: np.ndarray, fresh: np.ndarray) -> None:
        """Offer the nodes ``fresh (len(at), m)``, -1 for none, to the beams of the queries ``at``."""
        fresh = np.sort(fresh, axis=1)
        repeated = np.zeros(fresh.shape, bool)
        repeated[:, 1:] = fresh[:, 1:] == fresh[:, :-1]
        bad = repeated | seen[at[:, None], fresh]
        seen[at[:, None], fresh] = True
        distance = lengths[fresh] - 2 * np.einsum("rmd,rd->rm", points[fresh], queries[at])
        distance[bad] = np.inf
        all_far = np.concatenate((far[at], distance), axis=1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[at] = np.take_along_axis(all_far, best, axis=1)
        nodes[at] = np.take_along_axis(np.concatenate((nodes[at], fresh), axis=1), best, axis=1)
        flags = np.concatenate((done[at], bad), axis=1)
        done[at] = np.take_along_axis(flags, best, axis=1)

    enter(rows, np.broadcast_to(entries, (count, len(entries))).copy())
    while True:
        open_ = ~done
        at = np.flatnonzero(open_.any(axis=1))
        if not len(at):
            break
        turn = np.cumsum(open_[at], axis=1)
        chosen = open_[at] & (turn <= AT_ONCE)
        where, place = np.nonzero(chosen)
        slot = turn[where, place] - 1
        expand = np.full((len(at), AT_ONCE), -1, np.int64)
        expand[where, slot] = nodes[at][where, place]
        done[at[where], place] = True
        fresh = edges[expand]
        fresh[expand < 0] = -1
        enter(at, fresh.reshape(len(at), -1))
    nodes[~np.isfinite(far)] = -1
    return nodes, far + _squares(queries)[:, None]


def robust_prune(points: np.ndarray, own: np.ndarray, offered: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Out-edges ``(len(own), degree)``, -1 for none, chosen from ``offered`` (-1 for none)."""
    out = np.full((len(own), degree), -1, np.int64)
    for at in range(0, len(own), BATCH):
        me, cand = own[at : at + BATCH], np.sort(offered[at : at + BATCH], axis=1)
        bad = (cand < 0) | (cand == me[:, None])
        bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
        near = _squares(points[cand] - points[me][:, None, :])
        near[bad] = np.inf
        order = np.argsort(near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        vectors = points[cand]
        size = _squares(vectors)
        between = size[:, :, None] + size[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        alive = np.isfinite(near)
        rows = np.arange(len(me))
        for slot in range(degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            first = alive.argmax(axis=1)
            out[at : at + BATCH][some, slot] = cand[some, first[some]]
            covered = alpha * alpha * between[rows, first] <= near
            alive &= ~covered
            alive[rows, first] = False
    return out


def _add_reverse(points: np.ndarray, edges: np.ndarray, sources: np.ndarray, alpha: float) -> None:
    degree = edges.shape[1]
    targets = edges[sources].ravel()
    origins = np.repeat(sources, degree)
    keep = targets >= 0
    targets, origins = targets[keep], origins[keep]
    order = np.argsort(targets, kind="stable")
    targets, origins = targets[order], origins[order]
    named, start, count = np.unique(targets, return_index=True, return_counts=True)
    for low, high in ((1, 8), (9, 32), (33, 128), (129, len(sources))):
        pick = np.flatnonzero((count >= low) & (count <= high))
        if not len(pick):
            continue
        width = int(count[pick].max())
        step = max(1, (BATCH * 64) // (width + degree))
        for at in range(0, len(pick), step):
            part = pick[at : at + step]
            offset = np.arange(width)
            index = np.minimum(start[part][:, None] + offset, len(origins) - 1)
            fresh = np.where(offset < count[part][:, None], origins[index], -1)
            both = np.concatenate((edges[named[part]], fresh), axis=1)
            both = -np.sort(-both, axis=1)
            repeated = np.zeros(both.shape, bool)
            repeated[:, 1:] = both[:, 1:] == both[:, :-1]
            both[repeated] = -1
            both = -np.sort(-both, axis=1)
            full = (both >= 0).sum(axis=1) > degree
            edges[named[part][~full]] = both[~full, :degree]
            if full.any():
                edges[named[part][full]] = robust_prune(points, named[part][full], both[full], alpha, degree)


def _entries(edges: np.ndarray, first: int) -> np.ndarray:
    """The entry, and one node of every part that the entries before do not reach."""
    reached = np.zeros(len(edges), bool)
    entries, at = [], first
    while True:
        entries.append(at)
        front = np.array([at])
        reached[at] = True
        while len(front):
            step = np.unique(edges[front])
            front = step[(step >= 0) & ~reached[step]]
            reached[front] = True
        if reached.all():
            return np.array(entries)
        at = int(np.argmin(reached))


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Out-edges and entries for the rows of ``vectors``."""
    rng = np.random.default_rng(SEED)
    points, count = _lengthened(vectors), len(vectors)
    degree = min(degree, max(1, count - 1))
    edges = rng.integers(0, count, (count, degree))
    edges[edges == np.arange(count)[:, None]] = -1
    entry = int(_squares(points - points.mean(axis=0)).argmin())
    for alpha in (1.0, ALPHA):
        order = rng.permutation(count)
        for at in range(0, count, BATCH):
            own = order[at : at + BATCH]
            near, _ = beam_search(points, edges, np.array([entry]), points[own], beam)
            edges[own] = robust_prune(points, own, np.concatenate((near, edges[own]), axis=1), alpha, degree)
            _add_reverse(points, edges, own, alpha)
    return edges, _entries(edges, entry)


def _lengthened(vectors: np.ndarray) -> np.ndarray:
    """Equally long single-precision vectors: scaled to at most length one, with one more dimension."""
    lengths = _squares(vectors)
    top = lengths.max()
    scaled = vectors / np.sqrt(top)
    return np.concatenate((scaled, np.sqrt(np.maximum(1 - lengths / top, 0))[:, None]), axis=1).astype(np.float32)


class Shard:
    """One shard's nodes: distinct vectors with their ids, and the graph over them."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, starts: np.ndarray, edges: np.ndarray, entries: np.ndarray) -> None:
        self.vectors, self.ids, self.starts, self.edges, self.entries = vectors, ids, starts, edges, entries
        self.points = _lengthened(vectors)

    @staticmethod
    def built(ids: np.ndarray, vectors: np.ndarray) -> Shard:
        order = np.lexsort((ids, *vectors.T))
        ids, vectors = ids[order], vectors[order]
        new = np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1)))
        starts = np.append(np.flatnonzero(new), len(ids))
        nodes = vectors[new]
        return Shard(nodes, ids, starts, *build_graph(nodes))

    def packed(self) -> list[bytes]:
        parts = (self.vectors, self.ids, self.starts, self.edges.astype(np.int64), self.entries.astype(np.int64))
        return [np.ascontiguousarray(p).tobytes() for p in parts]

    @staticmethod
    def opened(vectors: bytes, ids: bytes, starts: bytes, edges: bytes, entries: bytes) -> Shard:
        whole = lambda b: np.frombuffer(b, np.int64)
        count = len(whole(starts)) - 1
        return Shard(
            np.frombuffer(vectors, np.float64).reshape(count, -1), whole(ids), whole(starts), whole(edges).reshape(count, -1), whole(entries)
        )

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, found ids and scores: up to k per query, without the query's own id."""
        if queries.shape[1] != self.vectors.shape[1]:
            raise ValueError("vectors of different lengths")
        sizes = np.sqrt(_squares(queries))
        scaled = np.concatenate((queries / sizes[:, None], np.zeros((len(queries), 1))), axis=1).astype(np.float32)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(queries), BATCH):
            nodes, _ = beam_search(self.points, self.edges, self.entries, scaled[at : at + BATCH], max(beam, k + 1))
            for i, near in enumerate(nodes, start=at):
                near = near[near >= 0]
                scores = np.einsum("nd,d->n", self.vectors[near], queries[i])
                order = np.argsort(-scores, kind="stable")[: k + 1]
                found = [self.ids[self.starts[n] : self.starts[n + 1]][: k + 1] for n in near[order]]
                ids = np.concatenate(found)
                score = np.repeat(scores[order], [len(f) for f in found])
                keep = ids != own[i]
                ids, score = ids[keep], score[keep]
                best = np.lexsort((ids, -score))[:k]
                out.append((np.full(len(best), own[i]), ids[best], score[best]))
        return tuple(map(np.concatenate, zip(*out)))


_PARTS = ("vectors", "ids", "starts", "edges", "entries")
_INDEX = "shard long, " + ", ".join(f"{p} binary" for p in _PARTS)


def graph_index(whole: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """One row per shard with its graph, checkpointed, and the number of shards."""
    shards = max(1, -(-whole.count() // shard_rows))
    dealt = whole.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def finished() -> pa.RecordBatch:
            shard = Shard.built(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))
            columns = [pa.array([now], pa.int64())] + [pa.array([p], pa.binary()) for p in shard.packed()]
            return pa.RecordBatch.from_arrays(columns, ["shard", *_PARTS])

        for batch in batches:
            keys = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                if keys[a] != now and held:
                    yield finished()
                    held = []
                now = keys[a]
                part = batch.slice(a, b - a)
                held.append((part.column("vec_id").to_numpy(), _matrix(part.column("v"))))
        if held:
            yield finished()

    grouped = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
    return cut_lineage(grouped.mapInArrow(run, _INDEX)), shards


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int = K, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the k best found over all shards for ``queries (vec_id, v)``."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    nothing = [F.lit(None).cast("binary").alias(p) for p in _PARTS]
    asked = queries.select(every.alias("shard"), F.lit(1).alias("kind"), "vec_id", "v", *nothing)
    graphs = index.select(
        "shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("v"), *_PARTS
    )
    met = graphs.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            opens = np.flatnonzero(kinds == 0)
            for a, b in zip([0, *opens], [*opens, len(kinds)]):
                if a < b and kinds[a] == 0:
                    shard = Shard.opened(*(batch.column(p)[a].as_py() for p in _PARTS))
                    a += 1
                if a < b:
                    part = batch.slice(a, b - a)
                    found = shard.search(part.column("vec_id").to_numpy(), _matrix(part.column("v")), k, beam)
                    types = (pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: k near candidates by inner product, nearest first.

    Queries are the rows that ``is_query`` selects, candidates all rows but those with the query's
    own id; fewer than k candidates are all returned, ties go to the smaller id. A repeated row is a
    candidate as often as it stands there; of several rows with one query id the least vector asks.
    An empty table gives no rows, columns beyond ``vec_id`` and ``embedding`` are ignored, vectors of
    different lengths are an error.
    """
    whole = cut_lineage(valid_vectors(vectors.select("vec_id", "embedding")))
    index, shards = graph_index(whole, shard_rows)
    asked = whole.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    return search_index(index, shards, asked, k, beam)
