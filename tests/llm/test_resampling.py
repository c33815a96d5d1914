from collections import Counter
import hashlib
import math
import re
import zlib

import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import queries, resampling

SF = "/root/testdata/sf0.001"
TEXT = "Alpha beta gamma 12 über ÜBER naïve x_y"
ODD = [
    (1, TEXT * 5, "x", 1),
    (2, None, None, None),
    (3, "", "x", 1),
    (4, "...  \x00 __", "x", 1),
    (None, TEXT * 4, "x", 1),
    (None, TEXT * 4, "x", 1),
    (5, TEXT * 4, "x", 1),
    (5, TEXT * 4, "x", 1),
    (6, "beta " * 19, "x", 1),
    (7, "beta " * 20, "x", 1),
    (8, "w" * 3_000_000 + " beta" * 400_000, "x", 1),
    (9, " ".join(f"tail{i}" for i in range(50)), "x", 1),
    (10, "alpha beta gamma delta " * 30, "x", 1),
] + [(i, f"{TEXT} word{i} alpha beta " * 4, "x", 1) for i in range(20, 50)]
TARGET = [(1, "alpha beta gamma"), (2, None), (3, "alpha beta Über alpha"), (4, "")]


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, runs, buckets):
    w = plain_words(text)
    runs_of = [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
    return Counter(zlib.crc32(r.encode()) % buckets for r in runs_of)


def plain_resampled(docs, target, runs=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    found = [plain_features(t, runs, buckets) for _, t in docs]
    s, t = sum(found, Counter()), sum((plain_features(x, runs, buckets) for x in target), Counter())
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for (doc_id, text), own in zip(docs, found):
        gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
        weight = sum(n * gain(b) for b, n in own.items())
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, own.total(), weight, score, None, len(plain_words(text)) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return Counter(tuple(r[:5]) for r in rows)


def frames(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, weight string, row long").repartition(4)
    return docs, spark.createDataFrame(TARGET, "item_id long, text string")


@pytest.mark.parametrize("options", [{}, {"percent": 100}, {"runs": 2, "buckets": 97, "percent": 50}, {"runs": 3, "buckets": 64, "percent": 100, "min_words": 1}])
@pytest.mark.parametrize("head", [0, 4, 20_000])
def test_odd_rows(spark, options, head):
    docs, target = frames(spark)
    want = plain_resampled([r[:2] for r in ODD], [t for _, t in TARGET], **options)
    got = Counter(tuple(r) for r in resampling.resampled(docs, target, head=head, **options).collect())
    assert got == want


def test_empty_tables(spark):
    docs, target = frames(spark)
    nothing = docs.limit(0)
    assert resampling.resampled(nothing, target).collect() == []
    got = Counter(tuple(r) for r in resampling.resampled(docs, target.limit(0), percent=100).collect())
    assert got == plain_resampled([r[:2] for r in ODD], [], percent=100)


def test_blocks_keep_runs_across_their_edges(monkeypatch):
    monkeypatch.setattr("edgeweave.llm.words.BLOCK", 7)
    text = "alpha beta gamma delta epsilon zeta eta theta " * 3
    head = resampling.Head([b"alpha", b"zeta"], [(b"alpha", b"beta"), (b"eta", b"theta")], 101)
    for runs in (1, 2, 3, 4):
        found = Counter(int(b) for _, part in head.blocks(text.encode(), runs) for b in part)
        assert found == plain_features(text, runs, 101)


def test_query_matches_sql(spark):
    got_columns, have = spark_bag(queries.op12_head_tail_resampling(spark, SF))
    want_columns, want = sql_bag(connect(SF), queries.oracle_sql()["op12_head_tail_resampling"])
    assert got_columns == want_columns
    assert have == want and have
