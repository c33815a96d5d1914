"""Quality scores of whole texts from a byte-level convolutional network in numpy.

**Network.** A text's UTF-8 bytes are cut into chunks of 32 bytes, one every 16 bytes, so that each
byte lies in two chunks and the whole text is covered. Each byte has a learned vector; a chunk also
has, for every lag from 1 to 48, how many of its bytes equal the byte so far before (this shows
repeated words and lines). Learned filters over a chunk are rectified and max-pooled over each
eighth of the text; a small dense layer reads each eighth's pooled values together with those of
the whole text, and the mean over the eighths goes through one logistic unit: one probability.

**Training.** At most ``per_class`` labelled ids per class are chosen by a hash of the id among the rows
that are not held out and have a text of at most ``max_bytes`` bytes; their texts train the network in one task.
The classes are weighted back to their shares among all labelled rows. Everything else (scores,
shares) covers all rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from edgeweave.llm.memory import free_names, returning
from edgeweave.session import written_table

HALF, LAGS, VECTOR, FILTERS, HIDDEN, PARTS = 16, 48, 4, 24, 12, 8
PER_CLASS, MAX_BYTES, THRESHOLD = 1500, 16384, 0.3
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.01, 7
WINDOW = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by five; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of half chunks, zero-filled, with ``LAGS`` zeros between; first half chunks."""
    gap = LAGS // HALF
    halves = [max(2, -(-len(t) // HALF)) for t in texts]
    firsts = np.concatenate(([0], np.cumsum([h + gap for h in halves])))
    flat = np.zeros((firsts[-1] + 1) * HALF, np.uint8)
    for t, first in zip(texts, firsts):
        flat[first * HALF : first * HALF + len(t)] = np.frombuffer(t, np.uint8)
    return flat, np.stack([firsts[:-1], firsts[:-1] + halves], axis=1)


def _repeats(flat: np.ndarray) -> np.ndarray:
    """Per half chunk and lag, the share of its bytes that equal the byte ``lag`` before."""
    out = np.zeros((len(flat) // HALF, LAGS), np.float32)
    text = flat != 0
    same = np.zeros(len(flat), bool)
    for lag in range(1, LAGS + 1):
        np.equal(flat[lag:], flat[:-lag], out=same[lag:])
        same[:lag] = False
        same &= text
        out[:, lag - 1] = np.bitwise_count(np.packbits(same).view(np.uint16))
    out *= 1.0 / HALF
    return out


def _inputs(flat: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    seen = vectors[flat].reshape(-1, HALF * VECTOR)
    return np.concatenate([seen, _repeats(flat)], axis=1)


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    width = HALF * VECTOR + LAGS
    return {
        "vectors": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        "left": rng.normal(0, width**-0.5, (width, FILTERS)).astype(np.float32),
        "right": rng.normal(0, width**-0.5, (width, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)).astype(np.float32),
        "dense_bias": np.zeros(HIDDEN, np.float32),
        "out": rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def _responses(model: dict[str, np.ndarray], flat: np.ndarray) -> np.ndarray:
    """Filter values of the chunk that begins at each half chunk (the last one has none)."""
    seen = _inputs(flat, model["vectors"])
    return np.maximum(seen[:-1] @ model["left"] + seen[1:] @ model["right"] + model["bias"], 0)


def _edges(chunks: int) -> np.ndarray:
    """Where the parts of a text begin; fewer chunks than parts make fewer parts."""
    parts = min(PARTS, chunks)
    return np.arange(parts) * chunks // parts


def _combined(model: dict[str, np.ndarray], pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    whole = np.broadcast_to(pooled.max(axis=0), pooled.shape)
    both = np.concatenate([pooled, whole], axis=1)
    hidden = np.maximum(both @ model["dense"] + model["dense_bias"], 0)
    return both, hidden, float(hidden.mean(axis=0) @ model["out"] + model["out_bias"][0])


def _logistic(x: float | np.ndarray) -> float | np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _long_pooled(model: dict[str, np.ndarray], text: bytes) -> np.ndarray:
    """The pooled values of a text of any length, from windows that overlap by the lags and one chunk."""
    chunks = -(-len(text) // HALF) - 1
    edges = np.append(_edges(chunks), chunks)
    pooled = np.zeros((len(edges) - 1, FILTERS), np.float32)
    lead = LAGS // HALF
    for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        for at in range(int(a), int(b), WINDOW // HALF):
            end, back = min(int(b), at + WINDOW // HALF), min(at, lead)
            flat = np.zeros((end - at + back + 1) * HALF, np.uint8)
            cut = np.frombuffer(text, np.uint8, count=min(len(flat), len(text) - (at - back) * HALF), offset=(at - back) * HALF)
            flat[: len(cut)] = cut
            pooled[part] = np.maximum(pooled[part], _responses(model, flat)[back:].max(axis=0))
    return pooled


def score_texts(model: dict[str, np.ndarray], texts: list[bytes]) -> list[float]:
    """One probability per text."""
    scores = np.zeros(len(texts))
    batch: list[int] = []
    size = 0

    def flush() -> None:
        if batch:
            flat, spans = _layout([texts[i] for i in batch])
            values = _responses(model, flat)
            for i, (first, end) in zip(batch, spans):
                pooled = np.maximum.reduceat(values[first : end - 1], _edges(end - 1 - first), axis=0)
                scores[i] = _logistic(_combined(model, pooled)[2])
        batch.clear()

    for i, text in enumerate(texts):
        if len(text) > WINDOW:
            scores[i] = _logistic(_combined(model, _long_pooled(model, text))[2])
            continue
        if size + len(text) > WINDOW // 4:
            flush()
            size = 0
        batch.append(i)
        size += len(text) + LAGS
    flush()
    return scores.tolist()


def _gradients(model, texts, labels, weights) -> dict[str, np.ndarray]:
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    flat, spans = _layout(texts)
    seen = _inputs(flat, model["vectors"])
    values = np.maximum(seen[:-1] @ model["left"] + seen[1:] @ model["right"] + model["bias"], 0)
    rows, filters, deltas = [], [], []
    for (first, end), label, weight in zip(spans, labels, weights):
        edges = np.append(_edges(end - 1 - first), end - 1 - first) + first
        best = np.stack([a + values[a:b].argmax(axis=0) for a, b in zip(edges[:-1], edges[1:])])
        pooled = np.take_along_axis(values, best, axis=0)
        both, hidden, logit = _combined(model, pooled)
        error = weight * (_logistic(logit) - label)
        grads["out"] += error * hidden.mean(axis=0)
        grads["out_bias"] += error
        d_hidden = (hidden > 0) * (error / len(hidden)) * model["out"]
        grads["dense"] += both.T @ d_hidden
        grads["dense_bias"] += d_hidden.sum(axis=0)
        d_both = d_hidden @ model["dense"].T
        d_pooled = d_both[:, :FILTERS].copy()
        d_pooled[pooled.argmax(axis=0), np.arange(FILTERS)] += d_both[:, FILTERS:].sum(axis=0)
        d_pooled *= pooled > 0
        rows.append(best.ravel())
        filters.append(np.tile(np.arange(FILTERS), len(best)))
        deltas.append(d_pooled.ravel())
    row, filt, delta = map(np.concatenate, (rows, filters, deltas))
    used = np.abs(delta) > 0
    row, filt, delta = row[used], filt[used], delta[used].astype(np.float32)
    d_values = np.zeros((len(flat) // HALF, FILTERS), np.float32)
    np.add.at(d_values, (row, filt), delta)
    touched = np.unique(row)
    d = d_values[touched]
    grads["left"] += seen[touched].T @ d
    grads["right"] += seen[touched + 1].T @ d
    grads["bias"] += d.sum(axis=0)
    halves = flat.reshape(-1, HALF)
    for side, at in (("left", touched), ("right", touched + 1)):
        d_seen = (d @ model[side].T)[:, : HALF * VECTOR].reshape(-1, VECTOR)
        for k in range(VECTOR):
            grads["vectors"][:, k] += np.bincount(halves[at].ravel(), weights=d_seen[:, k], minlength=256)
    return grads


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Fit the network with Adam; the same rows in the same order give the same network."""
    rng = np.random.default_rng(SEED)
    model = _start(rng)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            grads = _gradients(model, [texts[i] for i in pick], labels[pick], weights[pick])
            step += 1
            rate = RATE * (0.15 if epoch >= EPOCHS * 2 // 3 else 1)
            for k, g in grads.items():
                g = g / len(pick)
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.002 * (g * g - square[k])
                model[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.998**step)) + 1e-8)
    return model


def _packed(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as stored:
        return {k: stored[k] for k in stored.files}


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> bytes:
    """The trained network as bytes (some 40 KB), from labelled rows that are not held out.

    Rows with a null id, text or label, or a label other than 0 and 1, teach nothing. Without any
    labelled row the network stays as it starts. A class whose labels all miss the documents, or stand
    on texts that are too long, raises.
    """
    wanted = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    wanted = wanted.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("label_id")) & F.col("label_id").isNotNull())
    shares = {r["quality"]: r["rows"] for r in wanted.groupBy("quality").agg(F.count(F.lit(1)).alias("rows")).collect()}
    # ids only: labels without a text of fitting length take no place in the sample
    fitting = docs.filter(F.octet_length(F.col("text").cast("string")) <= max_bytes).select(F.col("doc_id").alias("label_id"))
    usable, _ = written_table(wanted.join(fitting, "label_id", "left_semi"), "labels")
    taught = {r["quality"] for r in usable.select("quality").distinct().collect()}
    for y in sorted(set(shares) - taught):
        empty = docs.filter(F.col("text").isNull()).select(F.col("doc_id").alias("label_id"))
        missed = wanted.filter(F.col("quality") == y).join(empty, "label_id", "left_anti")
        if docs.limit(1).count() and missed.limit(1).count():
            raise ValueError(f"no document of at most {max_bytes} bytes has one of the {shares[y]} labels of quality {y}")
    wanted = usable.withColumn("place", F.xxhash64("label_id", F.lit(SEED)))
    picked = [wanted.filter(F.col("quality") == y).orderBy("place", "label_id").limit(per_class) for y in (0, 1)]
    short = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    short = short.filter(F.octet_length("text") <= max_bytes)
    # at most 2 * per_class ids go to the documents, so no text is shuffled to find the sample
    known = short.join(F.broadcast(picked[0].unionByName(picked[1])), short["doc_id"] == F.col("label_id"))
    sample = known.select("place", "text", "quality").orderBy("place", "quality", "text").limit(2 * per_class)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"place": [], "text": [], "quality": []}), *batches])
        rows = rows.sort_values(["place", "quality", "text"], kind="stable")
        texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
        target = rows["quality"].to_numpy(np.float32)
        weights = np.ones(len(target), np.float32)
        for label in (0, 1):
            if (target == label).any():
                weights[target == label] = shares.get(label, 0) / (target == label).mean() / max(1, sum(shares.values()))
        yield pd.DataFrame({"model": [_packed(train(texts, target, weights))]})

    found = sample.coalesce(1).mapInPandas(returning(run), "model binary").first()
    return found["model"] if found else _packed(_start(np.random.default_rng(SEED)))


def scored(docs: DataFrame, model: bytes, score: str = "__score") -> DataFrame:
    """``docs`` with all its columns and one named by ``score``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = _unpacked(model)
        for rows in batches:
            for at in range(0, len(rows), 256):
                part = rows.slice(at, 256)
                texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in part.column("text")]
                found = pa.array(score_texts(network, texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, score])

    return docs.mapInArrow(returning(run), StructType([*docs.schema.fields, StructField(score, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs (doc_id, text)``.

    Repeated rows are scored alike and stay; a null id is kept and is not held out; an empty table
    gives an empty result; columns beyond the two are ignored.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = scored(kept, fit(docs, labels))
    predicted = (F.col("__score") >= THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), predicted)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns, whatever their names.

    A null or empty text is scored as empty and stays or goes by its score; repeated rows do so together; an
    empty table gives an empty result.
    """
    (score,) = free_names(docs.columns, "__score")
    return scored(docs, fit(docs, labels), score).filter(F.col(score) >= threshold).drop(score)
