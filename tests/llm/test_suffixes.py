import hashlib
import os
import random

import numpy as np
import pytest

from edgeweave.llm import queries, suffixes
from edgeweave.session import fresh_path
from edgeweave.sources.derived import table


def plain_counts(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256, kept bytes) per row, from all windows of all documents."""
    texts = [(t or "").encode() for _, t in rows]
    ranks = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for rank, text in zip(ranks, texts):
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            least[window] = min(rank, least.get(window, rank))
    out = []
    for (doc, _), rank, text in zip(rows, ranks, texts):
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - length + 1):
            if least[text[i : i + length]] < rank:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(text) else 0
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(out, key=str)


def some_rows(seed=1):
    rng = random.Random(seed)
    letters = "abcdé \n\0ü"
    passages = ["".join(rng.choices(letters, k=rng.choice([30, 49, 50, 51, 80, 200]))) for _ in range(8)]
    rows = []
    for i in range(70):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(rng.randrange(8))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[rng.randrange(70)][1]) for i in range(15)]
    rows += [(200, None), (201, ""), (None, passages[-1] * 2), (None, rows[5][1]), (3, rows[3][1]), (3, rows[3][1]), (4, passages[4])]
    rows += [(300, "ab" * 1500), (301, "ab" * 800 + "x"), (302, "z" * 49), (303, "z" * 49), (304, "q" * 50), (305, "q" * 50)]
    rows += [(-7, rows[10][1]), (400, "".join(rng.choices(letters, k=9000))), (401, rows[-1][1][100:5000])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(rows)], "doc_id long, text string, mark int, n_bytes string")


@pytest.mark.parametrize("crowd", [50_000, 2])
def test_matches_brute_force(spark, crowd):
    rows = some_rows()
    out = suffixes.remove_repeats(frame(spark, rows).repartition(3), fresh_path(spark, "t"), ("mark",), crowd=crowd)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in out.collect()), key=str)
    assert got == plain_counts(rows)
    assert sorted(r.mark for r in out.collect()) == list(range(len(rows)))


def test_small_chunks_and_batches(monkeypatch):
    """The steps by themselves, with many chunks, shards and batches."""
    import pyarrow as pa

    rows = some_rows(2)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 300)
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    monkeypatch.setattr(suffixes, "LONGEST_RUN", 5)
    texts = [t for _, t in rows]
    chunk = suffixes.Chunk(pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array(texts, pa.string())}))
    first, count, anchors, doc = suffixes.anchor_runs(chunk)
    windows = sorted((int(d), int(f) + j) for f, n, d in zip(first, count, doc) for j in range(n))
    assert windows == sorted((d, p) for d in range(len(rows)) for p in range(int(chunk.starts[d]), int(chunk.ends[d]) - 49))
    data = chunk.data.tobytes()
    by_window = {}
    for f, n, a in zip(first, count, anchors):
        for j in range(n):
            assert by_window.setdefault(data[f + j : f + j + 50], a) == a


def test_bounded_prefixes_are_common_prefixes():
    rng = np.random.default_rng(3)
    for size in (1, 2, 60, 700):
        text = rng.integers(0, 3, size).astype(np.uint8)
        text = np.concatenate((text, text[: size // 2], text))
        ring = np.resize(text, len(text) + 50).tobytes()
        order = suffixes.bounded_suffix_order(text)
        heads = [ring[i : i + 50] for i in order]
        assert heads == sorted(heads) and sorted(order.tolist()) == list(range(len(text)))
        want = [0] + [os.path.commonprefix([a, b]) for a, b in zip(heads, heads[1:])]
        found = suffixes.bounded_prefixes(text[order - 1])
        assert found.tolist() == [0] + [len(w) if len(w) < 50 else -1 for w in want[1:]]


def test_files_go_and_empty_tables_work(spark):
    empty = frame(spark, some_rows()).limit(0)
    assert suffixes.repeat_counts(empty).collect() == []


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = sorted((tuple(r) for r in queries.op10_suffix_dedup(spark, sf).collect()), key=str)
    assert got == sorted((r[:5] for r in plain_counts(rows)), key=str)
    assert sum(r[2] for r in got) > 10_000


def test_pieces_are_compared_only_under_a_common_key(monkeypatch):
    rng = np.random.default_rng(6)
    body = rng.integers(97, 100, 400, dtype=np.uint8).tobytes()
    texts = [body[:90], body[20:120], body[200:260], body[300:400], b"a" * 130]
    keys, of, low = np.array([7, 7, 8, 9, 10, 7], np.uint64), np.array([0, 1, 2, 3, 4, 0]), np.array([5, 3, 8, 2, 6])
    asked = []
    least = suffixes._least_ids
    monkeypatch.setattr(suffixes, "_least_ids", lambda some, ids: asked.append(some) or least(some, ids))
    got, stops = suffixes._window_ids(texts, low, of, keys)
    windows = [[t[i : i + 50] for i in range(len(t) - 49)] for t in texts]
    want = [min(int(l) for l, other in zip(low, windows) if w in other) for own in windows for w in own]
    assert got.tolist() == want
    assert stops.tolist() == np.cumsum([len(w) for w in windows]).tolist()
    assert asked == [texts[:2]]


def test_levels_leave_out_neighbours_known_to_agree():
    rng = np.random.default_rng(7)
    text = np.frombuffer(rng.integers(97, 99, 3000, dtype=np.uint8).tobytes() * 2 + b"\0", np.uint8)
    order, same = suffixes._suffix_order(text)
    assert same.any() and not same.all()
    plain = suffixes.bounded_prefixes(text[order - 1])
    assert ((plain < 0) == same).all()
    assert (suffixes.bounded_prefixes(text[order - 1], same) == plain).all()


def test_many_partitions_do_not_multiply_the_rows_of_a_chunk():
    assert [suffixes.shard_count(n) for n in (1, 12, 51, 100, 600, 3000)] == [4, 48, 204, 400, 600, 3000]
