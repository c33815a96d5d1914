"""Words of whole texts as bytes, and their counts, combined in each task within a bounded piece of text.

A table of 256 bytes lower-cases A-Z and turns every byte that is no part of a word into a space, so a
text is cut by one ``translate`` and one ``split``. Bytes from 0x80 belong to words, which keeps every
character beyond ASCII whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
DIGITS = bytes(range(0x30, 0x3A))
BLOCK = 1 << 20  # bytes that are split at once
PIECE = 1 << 23  # bytes of text whose terms are counted together


def word_table(ascii_part: bytes) -> bytes:
    """For ``translate``: A-Z lower-cased, bytes neither in ``ascii_part`` nor beyond ASCII as spaces."""
    kept = bytes(b if b in ascii_part or b >= 0x80 else 0x20 for b in range(256))
    return kept.lower()


def word_blocks(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a megabyte of it at a time."""
    at, text = 0, text.translate(table)
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _counted_words(data: bytes, ends: np.ndarray, groups: np.ndarray, table: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Per group and term of the texts that end at ``ends``: group, term, occurrences, texts that hold it."""
    text = np.frombuffer(data.translate(table), np.uint8)
    inside = text != 0x20
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = ends[(ends > 0) & (ends < len(text))]  # a text may end in a word that the next one goes on with
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) - starts + 1
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    size = max(1, len(coded.dictionary))
    doc = np.searchsorted(ends, starts, side="right")
    own, n = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)  # a term in a text
    key, place = np.unique(groups[own // size] * size + own % size, return_inverse=True)
    counts = np.bincount(place, n, len(key)).astype(np.int64)
    return key // size, coded.dictionary.take(pa.array(key % size)), counts, np.bincount(place, minlength=len(key))


def term_pieces(docs: DataFrame, table: bytes, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys, term, n, docs)``: occurrences of every term under the string columns ``keys``, and rows that hold it.

    These are partial counts: each task combines ``PIECE`` bytes of text at a time; a longer text is counted on
    its own, in blocks.
    """
    names = [*keys, "term", "n", "docs"]

    def rows_of(values: list[tuple], group: np.ndarray, terms: pa.Array, n: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([v[i] for v in values], pa.string()).take(pa.array(group)) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*columns, terms.cast(pa.string()), pa.array(n, pa.int64()), pa.array(held, pa.int64())], names)

    def long_text(values: list[tuple], group: int, text: bytes) -> pa.RecordBatch:
        found: Counter = Counter()
        for words in word_blocks(text, table):
            found.update(words)
        n = np.fromiter(found.values(), np.int64, len(found))
        return rows_of(values, np.full(len(n), group), pa.array(list(found), pa.binary()), n, np.ones(len(n), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column("text")
            ends = np.cumsum(pa.compute.binary_length(texts).to_numpy().astype(np.int64))
            known: dict[tuple, int] = {}
            columns = [rows.column(k).to_pylist() for k in keys]
            groups = np.array([known.setdefault(tuple(c[i] for c in columns), len(known)) for i in range(len(texts))], np.int64)
            values, at = list(known), 0
            while at < len(texts):
                before = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
                data = b"".join(t.as_py() for t in texts.slice(at, stop - at))
                if len(data) > PIECE:
                    yield long_text(values, int(groups[at]), data)
                else:
                    yield rows_of(values, *_counted_words(data, ends[at:stop] - before, groups[at:stop], table))
                at = stop

    strings = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]
    kept = docs.select(*strings, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return kept.mapInArrow(run, ", ".join([*(f"{k} string" for k in keys), "term string, n long, docs long"]))
