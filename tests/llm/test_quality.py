import zlib

import numpy as np
import pytest

from edgeweave.llm import quality, queries
from edgeweave.sources.derived import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    texts = [b"plain words of a text that goes on and on " * 9, b"### $$$ ### $$$ %%% " * 9] * 8
    return quality.train(texts, np.array([1.0, 0.0] * 8, np.float32), np.ones(16, np.float32))


def plain_score(model, text):
    """The network over one text, chunk by chunk."""
    halves = max(2, -(-len(text) // 16))
    data = np.zeros(halves * 16, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    inputs = []
    for h in range(halves):
        block = range(h * 16, h * 16 + 16)
        same = [sum(i >= lag and data[i] == data[i - lag] != 0 for i in block) / 16 for lag in range(1, 49)]
        inputs.append(np.concatenate([model["vectors"][data[h * 16 : h * 16 + 16]].ravel(), same]))
    values = np.array(
        [np.maximum(inputs[i] @ model["left"] + inputs[i + 1] @ model["right"] + model["bias"], 0) for i in range(halves - 1)]
    )
    parts = min(8, len(values))
    edges = [i * len(values) // parts for i in range(parts)] + [len(values)]
    pooled = np.array([values[a:b].max(axis=0) for a, b in zip(edges, edges[1:])])
    both = np.array([np.concatenate([p, values.max(axis=0)]) for p in pooled])
    hidden = np.maximum(both @ model["dense"] + model["dense_bias"], 0).mean(axis=0)
    return 1 / (1 + np.exp(-(hidden @ model["out"] + model["out_bias"][0])))


def test_scores_match_a_plain_network(model, monkeypatch):
    texts = [b"", b"a", "é".encode() * 20, b"word " * 300, bytes(range(256)) * 5, b"\0" * 70]
    want = [plain_score(model, t) for t in texts]
    assert quality.score_texts(model, texts) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(quality, "WINDOW", 256)  # windows of a long text
    assert quality.score_texts(model, texts) == pytest.approx(want, abs=1e-4)


def test_scores_do_not_depend_on_the_batch(model):
    texts = [b"one two three " * n for n in range(1, 40)]
    alone = [quality.score_texts(model, [t])[0] for t in texts]
    assert quality.score_texts(model, texts) == pytest.approx(alone, abs=1e-5)


def test_held_out_accuracy(spark):
    rows = queries.op2_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 40
    assert np.mean([a == b for a, b in judged]) > 0.93


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (None, "x", "b"), (2, "", "c"), (2, "", "c"), (3, "long " * 50000, "d")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1), (3, 5, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "3", "None"]
    assert not next(r for r in rows if r.doc_id is None).held_out
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # null and empty alike
    assert quality.quality_scores(docs.limit(0), labels.limit(0)).collect() == []


def test_training_ids_stand_in_documents_of_fitting_length(spark):
    docs = spark.createDataFrame([(i, ("long " * 100 if i % 2 else "text ") + str(i)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 2 % 2, 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    # most labels have no document, half of the texts are long
    model = quality._unpacked(quality.fit(docs, labels, per_class=5, max_bytes=100))
    start = quality._start(np.random.default_rng(quality.SEED))
    assert any((model[k] != start[k]).any() for k in start)
    with pytest.raises(ValueError, match="no document of at most 100 bytes"):
        quality.fit(docs.filter("doc_id % 2 = 1"), labels, max_bytes=100)
    with pytest.raises(ValueError, match="quality 1"):
        quality.fit(docs, labels.filter("quality = 0 or doc_id >= 40"), max_bytes=100)
    assert quality.quality_scores(docs.limit(0), labels).collect() == []


def test_good_documents_keep_clashing_names(spark):
    docs = spark.createDataFrame([(1, "some text", 5.0, "x")], "doc_id long, text string, __score double, __SCORE_ string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = quality.good_documents(docs, labels, threshold=0.0)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.collect()] == [(1, "some text", 5.0, "x")]
