"""Packing of tokenised documents into training sequences along a Hilbert curve.

Every document becomes its token ids and one end id. A document's ids are counted into hashed
classes; the counts, scaled to length one, are projected to three dimensions with fixed random
signs, and the place of that point on a Hilbert curve is the document's sort key. Documents are
range-partitioned by that key (ties by a hash, so equal documents spread too) and sorted; each
range fills its sequences one after the other, cutting documents at their ends. So a sequence holds
documents that lie near each other on the curve, and every sequence but those at the end of a range
is full. The rest of a range is cut into sequences whose lengths are powers of two, which need no
padding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from edgeweave.llm.memory import returning
from edgeweave.session import cut_lineage

LENGTH, END_ID = 2048, 1
CLASSES, DIMENSIONS, BITS, SEED = 64, 3, 10, 11
CACHED_WORDS = 250_000  # and as many pieces: some 100 MB in a worker
# Latin letters without the dotted capital I, whose lower case has two characters; then printable
# ASCII marks but the apostrophe, which begins pieces such as 's.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)?([!-&(-/:-@[-`{-~]*)")
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder(dict):
    """Ids of white-space separated words as little-endian bytes, kept for words seen before.

    For tokenizers that drop white space and never merge across it, a text's ids are its words' ids
    in order. Plain Latin words and runs of marks are pieces of their own for these tokenizers, so
    they go to the model alone and are shared between words; any other word takes the whole path,
    as does one that may hold a special token.
    The first ``CACHED_WORDS`` words and pieces are kept; which ones does not change any ids.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.model = self.tokenizer.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            shown = piece if piece.isascii() else self.byte_level.pre_tokenize_str(piece)[0][0]
            known = self._packed([t.id for t in self.model.tokenize(shown)])
            if len(self.pieces) < CACHED_WORDS:
                self.pieces[piece] = known
        return known

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word) if len(word) < 100 else None
        if plain is None or "<|" in word:
            ids = self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        else:
            letters, marks = plain.groups()
            ids = (self._piece(letters.lower()) if letters else b"") + (self._piece(marks) if marks else b"")
        if len(self) < CACHED_WORDS and len(word) < 100:
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        words = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, words)), self.dtype)


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary, checked once to be of the kind it needs."""
    if path not in _encoders:
        found = WordEncoder(path)
        for probe in ("It's a  TEST\nof words, isn't it? ça ### #a# 12", "é x"):
            whole = found.tokenizer.encode(probe, add_special_tokens=False).ids
            if found.encode(probe).tolist() != whole:
                raise ValueError("this vocabulary does not encode word by word")
        _encoders[path] = found
    return _encoders[path]


def hilbert_place(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points ``(n, dims)`` with ``bits`` bits a dimension.

    Gray-code form: exchange and invert low bits from the highest bit down, then undo the Gray code.
    """
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            inverted = (x[:, d] >> level) & 1 == 1
            swap = np.where(inverted, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(inverted, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    place = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[:, d] >> level) & 1
    return place


def _point(ids: np.ndarray, signs: np.ndarray) -> np.ndarray:
    hashed = (ids.astype(np.uint32) * np.uint32(2654435769)) >> np.uint32(32 - CLASSES.bit_length() + 1)
    counts = np.bincount(hashed, minlength=CLASSES)
    length = np.sqrt((counts * counts).sum()) or 1.0
    return counts @ signs / (length * CLASSES**0.5)


def tokens(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, curve, tie, ids)`` per row; ``ids`` are the compressed token ids with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (CLASSES, DIMENSIONS))
        press = zstandard.ZstdCompressor(level=1)
        for rows in batches:
            for at in range(0, len(rows), 256):
                part = rows.slice(at, 256)
                packed, points, ties = [], [], []
                for text in part.column("text"):
                    ids = encoder.encode(text.as_py() or "")
                    points.append(_point(ids, signs))
                    whole = ids.tobytes() + np.array([end_id], encoder.dtype).tobytes()
                    packed.append(press.compress(whole))
                    ties.append(zlib.crc32(packed[-1]))
                scaled = np.clip((np.array(points) + 1) / 2, 0, 1) * ((1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(hilbert_place(np.rint(scaled).astype(np.int64)), pa.int64()),
                        pa.array(ties, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "curve", "tie", "ids"],
                )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = kept.mapInArrow(returning(run), "doc_id long, curve long, tie long, ids binary")
    return found.withColumn("tie", F.xxhash64("doc_id", "tie"))


class _Range:
    """Fills the sequences of one range of the curve, holding no more than the open one."""

    def __init__(self, first_id: int, length: int) -> None:
        self.sequence, self.length = first_id, length
        self.open: list[tuple[int | None, int, np.ndarray, int]] = []
        self.filled = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            take = min(self.length - self.filled, len(ids) - at)
            self.open.append((doc_id, at, ids[at : at + take], len(ids)))
            self.filled, at = self.filled + take, at + take
            if self.filled == self.length:
                self._close(self.length)

    def _close(self, room: int) -> None:
        """Write the first ``room`` ids of the open pieces as one sequence."""
        offset, rest = 0, []
        for doc_id, start, ids, total in self.open:
            now, later = ids[: room - offset], ids[max(0, room - offset) :]
            if len(now):
                crc = zlib.crc32(now.astype("<u4").tobytes())
                self.rows.append((doc_id, start, len(now), crc, total, self.sequence, offset))
                offset += len(now)
            if len(later):
                rest.append((doc_id, start + len(now), later, total))
        self.open, self.filled = rest, self.filled - offset
        self.sequence += 1

    def finish(self) -> None:
        """Cut what is left into sequences of powers of two, the largest first."""
        while self.filled:
            self._close(1 << (self.filled.bit_length() - 1))

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(_PIECE.names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE.types)], schema=_PIECE)


_PIECE = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def packed(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all rows.

    A null or empty text is one end id. Repeated rows are packed once each; a null id stays null. An
    empty table gives no pieces; columns beyond ``doc_id`` and ``text`` are ignored.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("the length of a sequence must be a power of two")
    found = cut_lineage(tokens(docs, vocabulary, end_id))
    ranged = found.repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = word_encoder(vocabulary).dtype
        unpress = zstandard.ZstdDecompressor()
        current = _Range(TaskContext.get().partitionId() << 40, length)
        for rows in batches:
            for doc_id, ids in zip(rows.column("doc_id"), rows.column("ids")):
                current.add(doc_id.as_py(), np.frombuffer(unpress.decompress(ids.as_py()), dtype))
                if len(current.rows) >= 10_000:
                    yield current.taken()
        current.finish()
        yield current.taken()

    columns = ", ".join(f"{c} long" for c in _PIECE.names)
    return ranged.mapInArrow(returning(run), columns)
