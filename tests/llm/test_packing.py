import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edgeweave.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, pieces, tokenizer, length=2048):
    """The pieces are exactly the documents' ids, and the sequences have no gaps and little padding."""
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    covered = {}
    for p in pieces:
        texts = [t for t in ids[p.doc_id] if len(t) == p.doc_tokens]
        part = [np.array(t[p.start : p.start + p.length], "<u4").tobytes() for t in texts]
        assert p.length > 0 and p.ids_crc32 in {zlib.crc32(x) for x in part}
        covered.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.start + p.length))
    for doc, texts in ids.items():
        for total in {len(t) for t in texts}:
            cells = [0] * total
            for a, b in covered[doc, total]:
                for i in range(a, b):
                    cells[i] += 1
            assert set(cells) == {sum(len(t) == total for t in texts)}
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0  # full or a power of two: no padding


def test_words_and_whole_texts_agree(tokenizer):
    rng = random.Random(1)
    alphabet = list("abcXYZ'’éÉİßςΣŒĳŉ.,!?#$%&*|-_012٣ 中é́́   \t\n\x1c\x0b<>|") + [" ", "\n", "'s", "<|endoftext|>", "...", "#", "ﬁ"]
    encoder = packing.word_encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(0, 30)))
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_full_cache_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    encoder = packing.WordEncoder(PATH)
    text = "one two, three. Four five### six one two"
    for _ in range(2):
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_neighbours():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), axis=-1).reshape(-1, 3)
    place = packing.hilbert_place(grid, bits=3)
    assert sorted(place.tolist()) == list(range(512))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packed(spark, tokenizer):
    rng = random.Random(5)
    words = ["alpha", "beta.", "Gamma,", "delta's", "é", "12"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 300, 3000])))) for i in range(60)]
    rows += [(100, None), (101, ""), (7, rows[7][1]), (None, "no id"), (102, "x" * 3000), (103, "same"), (104, "same")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, sequence_id int")
    check(rows, packing.packed(docs, PATH).collect(), tokenizer)
    check(rows, packing.packed(docs, PATH, length=64).collect(), tokenizer, 64)
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_equal_documents_spread_over_ranges(spark):
    docs = spark.createDataFrame([(i, "the same words") for i in range(4000)], "doc_id long, text string")
    rows = packing.packed(docs, PATH).collect()
    sizes = np.bincount([r.sequence_id >> 40 for r in rows])
    assert len(rows) >= 4000 and sizes.max() < 1200


def test_neighbours_share_sequences(spark):
    docs = spark.createDataFrame(
        [(i, ("red apple pear plum " if i % 2 else "iron steel zinc lead ") * 40) for i in range(400)], "doc_id long, text string"
    )
    rows = packing.packed(docs, PATH).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r.sequence_id, set()).add(r.doc_id % 2)
    assert sum(len(k) == 2 for k in kinds.values()) <= 2
