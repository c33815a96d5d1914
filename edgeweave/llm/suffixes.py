"""Removal of passages that stand in an earlier document, by threshold-bounded interval expansion.

A byte is removed when it is covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id. The job has five steps; between them only digests, short pieces of text and
answers are shuffled, each addressed to a *chunk*, a file with about ``CHUNK_BYTES`` of whole
documents in the shared folder.

1. *Chunks.* Documents are written to chunk files. Every window of ``LENGTH`` bytes has an anchor, the
   least hash among its grams of ``GRAM`` bytes, so equal windows have equal anchors. A chunk sends
   the distinct anchors of its windows with their document counts, split by hash into buckets.
2. *Buckets.* A bucket adds up the counts and answers each chunk which anchors stand in several
   documents and which of those are crowded (more than ``CROWD`` documents).
3. *Pieces.* A chunk cuts the runs of windows with a repeated anchor from its documents, keeps each
   distinct piece once with the least and largest id that has it, and sends the pieces to the shard
   of their anchor. Windows with a crowded anchor go one by one, each to a shard of its own hash: a
   shard then gets a window at most once per chunk, however many documents share it.
4. *Intervals.* A shard concatenates the distinct pieces of whole anchors, sorts their suffixes by
   ``LENGTH`` bytes and forms the Burrows-Wheeler transform. ``bounded_prefixes`` expands intervals
   breadth first by backward extension and so finds the common prefixes of neighbours by increasing
   value, up to ``LENGTH``; boundaries that it does not reach separate nothing, so the intervals in
   between are the distinct strings. The least id of each goes back to the chunks that need it.
5. *Removal.* A chunk marks what its own documents repeat.

Chunks and pieces are the same when a task runs again, so a lost executor only repeats work. Files
are written and opened through ``pyarrow.fs``, which must know the folder's scheme.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
import xxhash
import zstandard

from edgeweave.llm.memory import returning, returning_table
from edgeweave.session import cut_lineage, drop_table, fresh_path

LENGTH, GRAM, CROWD = 50, 20, 50_000
CHUNK_BYTES, BLOCK, SHARD_BYTES, LONGEST_RUN = 8 << 20, 1 << 14, 1 << 20, 1024
SHARDS = 400  # few partitions get up to four shards each to even them out, many get one
LAST = np.iinfo(np.int64).max  # the rank of a null id


# Files and packed columns


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _store(uri: str, table: pa.Table) -> None:
    """Write a table in one step: a second attempt replaces the file by an equal one."""
    system, path = _place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(draft, compression=None) as out:
        with ipc.new_file(out, table.schema, options=ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
    system.move(draft, path)


def _load(uri: str) -> pa.Table:
    system, path = _place(uri)
    with system.open_input_file(path) as source:
        return ipc.open_file(source).read_all()


def _press(arrays: list[np.ndarray]) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    whole = b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=1).compress(whole)


def _unpress(data: bytes, dtypes: list) -> list[np.ndarray]:
    whole = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(whole, np.int64, len(dtypes))
    at, out = 8 * len(dtypes), []
    for size, dtype in zip(sizes, dtypes):
        out.append(np.frombuffer(whole, dtype, int(size) // np.dtype(dtype).itemsize, at))
        at += int(size)
    return out


class Chunk:
    """The documents of a chunk as one array of bytes, with the rank (id) of each."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table.combine_chunks()
        texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in self.table.column("text")]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in texts], np.int64)
        self.ranks = self.table.column("doc_id").fill_null(LAST).to_numpy()


# Anchors


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(0x9E3779B97F4A7C15, exponent, 1 << 64))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the GRAM bytes at each place, by doubling."""
    width, held, total, size = data.astype(np.uint64) + np.uint64(1), None, 0, 1
    rest = GRAM
    while rest:
        if rest & 1:
            if held is None:
                held, total = width, size
            else:
                n = len(held) - size
                held, total = held[:n] * _power(size) + width[total : total + n], total + size
        rest >>= 1
        if rest:
            n = len(width) - size
            width, size = width[:n] * _power(size) + width[size:], size * 2
    held = held[: len(data) - GRAM + 1]
    for _ in range(2):
        held = held ^ (held >> np.uint64(32))
        held *= np.uint64(0xD6E8FEB86659FD93)
    return held ^ (held >> np.uint64(32))


def window_anchors(data: np.ndarray) -> np.ndarray:
    """The anchor of the window that begins at each place; there are len(data) - LENGTH + 1."""
    span = LENGTH - GRAM + 1
    out = np.empty(max(0, len(data) - LENGTH + 1), np.uint64)
    for at in range(0, len(out), BLOCK):
        end = min(len(out), at + BLOCK)
        least, n = _gram_hashes(data[at : end + LENGTH - 1]), 1
        while n * 2 <= span:
            least, n = np.minimum(least[:-n], least[n:]), n * 2
        if span > n:
            least = np.minimum(least[: n - span], least[span - n :])
        out[at:end] = least
    return out


def _spread(anchors: np.ndarray) -> np.ndarray:
    """The least hashes lie near zero; this maps them one to one over the whole range."""
    mixed = anchors * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def anchor_runs(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: first window, number of windows, anchor, document."""
    anchors = window_anchors(chunk.data)
    new = np.ones(len(anchors), bool)
    new[1:] = anchors[1:] != anchors[:-1]
    valid = np.ones(len(anchors), bool)
    begins = chunk.starts[chunk.starts < len(anchors)]
    new[begins] = True
    for a, b in zip(np.maximum(chunk.starts, chunk.ends - LENGTH + 1).tolist(), chunk.ends.tolist()):
        valid[a:b] = False  # windows that would leave the document
    stops = np.flatnonzero(new[1:] | ~valid[1:]) + 1
    stops = np.append(stops, len(anchors))
    first = np.flatnonzero(new & valid)
    count = stops[np.searchsorted(stops, first, side="right")] - first if len(first) else first
    parts = -(-count // LONGEST_RUN)  # repetitive text has long runs
    if (parts > 1).any():
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        end = np.repeat(first + count, parts)
        first = np.repeat(first, parts) + step * LONGEST_RUN
        count = np.minimum(LONGEST_RUN, end - first)
    return first, count, _spread(anchors[first]), np.searchsorted(chunk.ends, first, side="right")


def _bucket_edges(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted anchors; buckets are equal ranges of the hash."""
    edges = [(b << 64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(anchors, np.array(edges, np.uint64)), len(anchors))


# Step 1


def _chunked(docs: DataFrame, folder: str, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def finished() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            chunk = Chunk(table)
            name = f"{folder}/{part}-{number}"
            _store(name, table)
            _, _, anchors, doc = anchor_runs(chunk)
            order = np.lexsort((doc, anchors))
            anchors, doc = anchors[order], doc[order]
            new = np.ones(len(anchors), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
            distinct, counts = np.unique(anchors[new], return_counts=True)
            edges = _bucket_edges(distinct, buckets)
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                span = slice(edges[b], edges[b + 1])
                more = np.flatnonzero(counts[span] > 1)
                packed = (distinct[span].astype(np.uint32), more.astype(np.uint32), counts[span][more].astype(np.uint32))
                rows.append((name, int(b), _press(list(packed))))
            if not rows:  # every chunk is heard of in every step
                rows.append((name, (part + number) % buckets, _press([np.zeros(0, np.uint32)] * 3)))
            columns = zip(*rows)
            types = (pa.string(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["chunk", "bucket", "payload"])

        size = 0
        for batch in batches:
            texts = batch.column("text")
            at = 0
            for i in range(len(batch)):
                size += len(texts[i].as_py() or "") * 2
                if size >= CHUNK_BYTES * 2:
                    held.append(batch.slice(at, i + 1 - at))
                    yield finished()
                    held, number, size, at = [], number + 1, 0, i + 1
            if at < len(batch):
                held.append(batch.slice(at))
        if held:
            yield finished()

    return docs.mapInArrow(returning(run), "chunk string, bucket int, payload binary")


# Step 2


def _answer_anchors(crowd: int):
    def run(table: pa.Table) -> pa.Table:
        names = table.column("chunk").to_pylist()
        payloads = [_unpress(p.as_py(), [np.uint32] * 3) for p in table.column("payload")]
        counts = []
        for hashes, at, count in payloads:
            n = np.ones(len(hashes), np.int64)
            n[at] = count
            counts.append(n)
        _, place = np.unique(np.concatenate([p[0] for p in payloads]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts)) if len(place) else np.zeros(0)
        kind = ((total > 1).astype(np.uint8) + (total > crowd))[place]
        ends = np.cumsum([len(p[0]) for p in payloads])
        answers = [_press([kind[e - len(p[0]) : e]]) for e, p in zip(ends, payloads)]
        return pa.table({"chunk": names, "bucket": table.column("bucket"), "kinds": pa.array(answers, pa.binary())})

    return run


# Step 3

_PIECES = [np.uint64, np.uint32, np.uint32, np.int64, np.int64, np.uint8]  # key, number, length, least, largest, text
_OCCURRENCES = ("piece", "doc", "first")


def _pieces_of(chunk: Chunk, kinds: np.ndarray) -> tuple[list[bytes], np.ndarray, dict[str, np.ndarray]]:
    """Distinct pieces in the order they appear, their keys, and where each occurs."""
    first, count, anchors, doc = anchor_runs(chunk)
    kind = kinds[np.unique(anchors, return_inverse=True)[1]] if len(anchors) else np.zeros(0, np.uint8)
    usual, crowded = np.flatnonzero(kind == 1), np.flatnonzero(kind > 1)
    windows = count[crowded]
    inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.concatenate((first[usual], np.repeat(first[crowded], windows) + inner))
    ends = np.concatenate((first[usual] + count[usual], starts[len(usual) :] + 1)) + LENGTH - 1
    docs = np.concatenate((doc[usual], np.repeat(doc[crowded], windows)))
    data, known = chunk.data.tobytes(), {}
    numbers = np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
    keys = np.zeros(len(known), np.uint64)
    keys[numbers[: len(usual)]] = anchors[usual]
    texts = list(known)
    alone = np.unique(numbers[len(usual) :])
    keys[alone] = [xxhash.xxh64_intdigest(texts[n], 1) for n in alone]
    order = np.argsort(numbers, kind="stable")
    return texts, keys, {"piece": numbers[order], "doc": docs[order], "first": starts[order]}


def _cut_pieces(shards: int):
    def run(table: pa.Table) -> pa.Table:
        name = table.column("chunk")[0].as_py()
        buckets = table.column("bucket").to_numpy()
        answers = [table.column("kinds")[int(i)].as_py() for i in np.argsort(buckets, kind="stable")]
        kinds = np.concatenate([_unpress(a, [np.uint8])[0] for a in answers])
        chunk = Chunk(_load(name))
        texts, keys, where = _pieces_of(chunk, kinds)
        _store(name + ".occurrences", pa.table({c: pa.array(where[c]) for c in _OCCURRENCES}))
        ranks = chunk.ranks[where["doc"]]
        begin = np.searchsorted(where["piece"], np.arange(len(texts)))
        least = np.minimum.reduceat(ranks, begin) if len(texts) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(ranks, begin) if len(texts) else np.zeros(0, np.int64)
        shard = (keys % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys, shard))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        rows: list[tuple] = []
        for s in np.flatnonzero(np.diff(edges)):
            pick = order[edges[s] : edges[s + 1]]
            body = np.frombuffer(b"".join([texts[i] for i in pick]), np.uint8)
            packed = [keys[pick], pick.astype(np.uint32), lengths[pick].astype(np.uint32), least[pick], most[pick], body]
            rows.append((int(s), name, _press(packed)))
        if not rows:
            rows.append((xxhash.xxh32_intdigest(name) % shards, name, _press([np.zeros(0, t) for t in _PIECES])))
        columns = zip(*rows)
        types = (pa.int32(), pa.string(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["shard", "chunk", "pieces"])

    return run


# Step 4


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks, and an order that sorts the values."""
    order = np.argsort(values)
    ordered = values[order]
    step = np.zeros(len(values), np.int64)
    step[1:] = ordered[1:] != ordered[:-1]
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.cumsum(step)
    return ranks, order


def bounded_suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of ``text``, read as a ring, sorted by the LENGTH bytes from there on."""
    return _suffix_order(text)[0]


def _suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, and which of them have the same LENGTH bytes as the one before."""
    n = len(text)
    padded = np.resize(text, n + LENGTH + 8).astype(np.uint64)
    eight = padded[: n + LENGTH].copy()
    for i in range(1, 8):
        eight <<= np.uint64(8)
        eight |= padded[i : i + n + LENGTH]
    ranks, order = _dense(eight)
    size = 8
    while size < LENGTH:
        shift = min(size, LENGTH - size)
        tail = np.concatenate((ranks[shift:], np.zeros(shift, np.int64)))
        ranks, order = _dense(ranks * np.int64(len(ranks)) + tail)
        size += shift
    order = order[order < n]
    same = np.zeros(n, bool)
    same[1:] = ranks[order[1:]] == ranks[order[:-1]]
    return order, same


def bounded_prefixes(transform: np.ndarray, same: np.ndarray | None = None) -> np.ndarray:
    """Common prefixes of neighbouring suffixes, in order, as far as they are below LENGTH; -1 for the rest.

    ``same`` may tell neighbours that are known to agree in LENGTH bytes; no level looks at them.

    Intervals are expanded level by level. The intervals of strings of ``l`` bytes are those between
    the boundaries found up to level ``l``. Backward extension of an interval by a byte gives the
    interval of the longer string, and the place between two neighbouring occurrences of a byte in the
    transform becomes a boundary one level after the first boundary that falls between them. So each
    level looks, for the places still open, whether the last level's boundaries separate them.
    """
    n = len(transform)
    prefixes = np.full(n, -1, np.int8)
    came_from = np.argsort(transform, kind="stable").astype(np.int32)  # where backward extension comes from
    byte = transform[came_from]
    begins = np.ones(n, bool)
    begins[1:] = byte[1:] != byte[:-1]
    prefixes[begins] = 0
    fresh = np.flatnonzero(begins)
    still = np.flatnonzero(~begins if same is None else ~(begins | same)).astype(np.int32)
    low, high = came_from[still - 1], came_from[still]
    passed = np.empty(n, np.int32)
    for level in range(1, LENGTH):
        if not len(fresh) or not len(still):
            break
        marks = np.zeros(n, np.int8)
        marks[fresh] = 1
        np.cumsum(marks, dtype=np.int32, out=passed)
        found = passed[high] > passed[low]
        found &= prefixes[still] < 0
        fresh = still[found]
        prefixes[fresh] = level
        if len(fresh) * 8 > len(still):  # drop the settled places now and then
            rest = prefixes[still] < 0
            still, low, high = still[rest], low[rest], high[rest]
    return prefixes


def _least_ids(texts: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every piece, in order, the least id among the pieces that have it; piece ends."""
    body = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.cumsum(lengths)
    piece = np.repeat(np.arange(len(texts)), lengths)
    order, same = _suffix_order(body)
    prefixes = bounded_prefixes(body[order - 1], same)
    valid = np.arange(len(body)) + LENGTH < ends[piece]
    ids = np.where(valid, least[piece], LAST)[order]
    begin = np.flatnonzero(prefixes >= 0)
    sizes = np.diff(np.append(begin, len(order)))
    out = np.empty(len(body), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(ids, begin), sizes)
    return out[valid], np.cumsum(lengths - LENGTH)


def _window_ids(texts: list[bytes], low: np.ndarray, of: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, told the key of every row and the piece that it holds.

    Equal windows have equal keys. So a piece without another one under its key shares no window with any: its own
    least id holds for all of them, and only the others are compared.
    """
    key = np.empty(len(texts), np.uint64)
    key[of] = keys
    _, place, pieces = np.unique(key, return_inverse=True, return_counts=True)
    several = pieces[place] > 1
    count = np.fromiter(map(len, texts), np.int64, len(texts)) - (LENGTH - 1)
    windows = np.repeat(low, count)
    if several.any():
        compared = np.flatnonzero(several)
        windows[np.repeat(several, count)] = _least_ids([texts[i] for i in compared], low[compared])[0]
    return windows, np.cumsum(count)


_RUNS = [np.uint32, np.uint32, np.uint32, np.int64]  # piece number in the chunk, first window, end window, least id


def _answer_pieces(table: pa.Table) -> pa.Table:
    names = table.column("chunk").to_pylist()
    packed = [_unpress(p.as_py(), _PIECES) for p in table.column("pieces")]
    key = np.concatenate([p[0] for p in packed])
    number = np.concatenate([p[1] for p in packed])
    length = np.concatenate([p[2] for p in packed]).astype(np.int64)
    least, most = np.concatenate([p[3] for p in packed]), np.concatenate([p[4] for p in packed])
    chunk = np.repeat(np.arange(len(packed)), [len(p[0]) for p in packed])
    body = b"".join(p[5].tobytes() for p in packed)
    ends = np.cumsum(length)
    answers: list[list[list[np.ndarray]]] = [[] for _ in packed]
    order = np.argsort(key, kind="stable")
    total = np.cumsum(length[order])
    keys = key[order]
    at = 0
    while at < len(order):
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + SHARD_BYTES, side="right"))
        end = min(max(end, at + 1), len(order))
        end = int(np.searchsorted(keys, keys[end - 1], side="right"))  # keys stay whole
        rows = order[at:end]
        known: dict[bytes, int] = {}
        of = np.array([known.setdefault(body[ends[i] - length[i] : ends[i]], len(known)) for i in rows])
        low = np.full(len(known), LAST)
        np.minimum.at(low, of, least[rows])
        windows, stops = _window_ids(list(known), low, of, keys[at:end])
        starts = stops - np.diff(np.append(0, stops))
        new = np.ones(len(windows), bool)
        new[1:] = windows[1:] != windows[:-1]
        new[starts] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(windows))
        owner = np.searchsorted(stops, first, side="right")
        bounds = np.searchsorted(owner, np.arange(len(known) + 1))
        count = np.diff(bounds)[of]  # runs of each row's piece
        run = np.repeat(bounds[of], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        row = np.repeat(rows, count)
        useful = windows[first[run]] < most[row]
        run, row = run[useful], row[useful]
        begin = starts[owner[run]]
        by = np.argsort(chunk[row], kind="stable")
        run, row, begin = run[by], row[by], begin[by]
        cuts = np.searchsorted(chunk[row], np.arange(len(packed) + 1))
        for c in np.flatnonzero(np.diff(cuts)):
            span = slice(cuts[c], cuts[c + 1])
            answers[c].append([number[row[span]], first[run[span]] - begin[span], last[run[span]] - begin[span], windows[first[run[span]]]])
        at = end
    out = []
    for parts in answers:
        columns = [np.concatenate([p[i] for p in parts] or [np.zeros(0)]).astype(t) for i, t in enumerate(_RUNS)]
        out.append(_press(columns))
    return pa.table({"chunk": names, "runs": pa.array(out, pa.binary())})


# Step 5


def _covered(chunk: Chunk, where: pa.Table, runs: list[list[np.ndarray]]) -> np.ndarray:
    """Which bytes of the chunk are removed."""
    piece, doc, first = (where.column(c).to_numpy() for c in _OCCURRENCES)
    change = np.zeros(len(chunk.data) + 1, np.int32)
    for number, begin, end, least in runs:
        low, high = np.searchsorted(piece, number, side="left"), np.searchsorted(piece, number, side="right")
        count = high - low
        run = np.repeat(np.arange(len(number)), count)
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        later = chunk.ranks[doc[at]] > least[run]
        run, at = run[later], at[later]
        np.add.at(change, first[at] + begin[run], 1)
        np.add.at(change, first[at] + end[run] + LENGTH - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _removed(columns: list[str], with_text: bool):
    def run(table: pa.Table) -> pa.Table:
        name = table.column("chunk")[0].as_py()
        chunk = Chunk(_load(name))
        covered = _covered(chunk, _load(name + ".occurrences"), [_unpress(r.as_py(), _RUNS) for r in table.column("runs")])
        removed, spans, digests, kept = [], [], [], []
        for a, b in zip(chunk.starts, chunk.ends):
            gone = covered[a:b]
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            rest = chunk.data[a:b][~gone].tobytes() if removed[-1] else chunk.data[a:b].tobytes()
            digests.append(hashlib.sha256(rest).hexdigest())
            if with_text:
                kept.append(rest.decode("utf-8", "ignore"))
        out = {c: chunk.table.column(c) for c in columns}
        if with_text:
            out["text"] = pa.array(kept, pa.string())
        sizes = pa.array(chunk.ends - chunk.starts, pa.int64())
        out |= {"n_bytes": sizes, "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64())}
        out["kept_sha256"] = pa.array(digests, pa.string())
        return pa.table(out)

    return run


def shard_count(parts: int) -> int:
    """Shards of the pieces; every chunk sends each of them a row, so they are no more than needed."""
    return max(parts, min(4 * parts, SHARDS))


def remove_repeats(docs: DataFrame, folder: str, extra: tuple[str, ...] = (), with_text: bool = True, crowd: int = CROWD) -> DataFrame:
    """``(doc_id, text, *extra, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``.

    ``text`` is what is left (characters that lost some of their bytes are dropped from it, not from the
    digest and counts); ``extra`` names columns to carry along. A null or empty text has no windows.
    A null id counts as larger than any other. Rows with the same id do not remove each other's
    text. An empty table gives no rows. The result reads files below ``folder``, which the caller
    removes when it is done.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    heard = _chunked(kept, folder, parts)
    known = heard.groupBy("bucket").applyInArrow(returning_table(_answer_anchors(crowd)), "chunk string, bucket int, kinds binary")
    # the rows of a chunk are few bytes and much work, so their partitions must not be merged by size
    sent = known.repartition(parts, "chunk").groupBy("chunk").applyInArrow(returning_table(_cut_pieces(shard_count(parts))), "shard int, chunk string, pieces binary")
    answers = sent.groupBy("shard").applyInArrow(returning_table(_answer_pieces), "chunk string, runs binary")
    columns = ["doc_id"] + (["text"] if with_text else []) + list(extra)
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns)
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return answers.repartition(parts, "chunk").groupBy("chunk").applyInArrow(returning_table(_removed([c for c in columns if c != "text"], with_text)), schema)


def repeat_counts(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row; see ``remove_repeats``."""
    folder = fresh_path(docs.sparkSession, "chunks")
    counts = cut_lineage(remove_repeats(docs, folder, with_text=False))
    drop_table(docs.sparkSession, folder)
    return counts
