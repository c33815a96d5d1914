"""Importance resampling towards a target: hashed n-gram features, log-ratio weights, Gumbel scores.

A feature is a run of 1 to ``runs`` consecutive words joined by one space, its bucket the CRC-32 of its bytes
modulo ``buckets``. The gain of a bucket compares its share of all target features with its share of
all features of the documents; a document's weight is the sum of the gains of its features, and the
documents with the highest ``weight + Gumbel noise`` are drawn, which samples without replacement.

**Head and tail.** Words are Zipf distributed, so few of them make up most features. The ``head`` most frequent
words of all documents are counted exactly and broadcast with their CRC states, and the most frequent pairs
of head words with their buckets. A feature of head words goes on from the state it finds there; any
other takes the CRC of its own bytes. Both ways give the same bucket, so the head changes time, never
rows. Totals are one array of ``buckets`` counts in each task, added up by bucket after the shuffle.

What is broadcast is bounded by parameters: ``head`` words of at most ``HEAD_BYTES`` bytes, as many pairs, and one
number a bucket. Ranks come from ranges over ``(score, doc_id, row)`` and the number of rows before each
range, so no task sorts more than its range.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.llm.words import DIGITS, LETTERS, term_pieces, word_blocks, word_table
from edgeweave.session import cut_lineage

RUNS, BUCKETS, SEED, MIN_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
HEAD, HEAD_BYTES = 20_000, 32
HELD = 200_000  # pairs that a task counts before it passes them on
TABLE = word_table(LETTERS + DIGITS)


class _States(dict):
    """CRC states of the head words; a word of the tail gets its own CRC and is not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Head:
    """States of frequent words and buckets of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> None:
        self.buckets = buckets
        self.states = _States((w, zlib.crc32(w)) for w in words)
        self.pairs = {(a, b): zlib.crc32(b" " + b, self.states[a]) % buckets for a, b in pairs}

    def found(self, words: list[bytes], runs: int, known: int = 0) -> np.ndarray:
        """Buckets of all runs of at most ``runs`` words that end after the first ``known`` words."""
        states = list(map(self.states.__getitem__, words))
        parts = [np.array(states[known:], np.int64) % self.buckets]
        for length in range(2, runs + 1):
            ends = range(max(known, length - 1), len(words))
            if length == 2:
                pairs, states_of = self.pairs, states
                parts.append(
                    np.fromiter(
                        (
                            pairs[two] if (two := (words[i - 1], words[i])) in pairs else zlib.crc32(b" " + words[i], states_of[i - 1]) % self.buckets
                            for i in ends
                        ),
                        np.int64,
                        len(ends),
                    )
                )
            else:
                rest = (zlib.crc32(b" " + b" ".join(words[i - length + 2 : i + 1]), states[i - length + 1]) for i in ends)
                parts.append(np.fromiter(rest, np.int64, len(ends)) % self.buckets)
        return np.concatenate(parts)

    def blocks(self, text: bytes, runs: int) -> Iterator[tuple[int, np.ndarray]]:
        """Number of words and buckets of all features, block by block of a text."""
        tail: list[bytes] = []
        for words in word_blocks(text, TABLE):
            joined = tail + words
            yield len(words), self.found(joined, runs, len(tail))
            tail = joined[len(joined) - min(len(joined), runs - 1) :] if runs > 1 else []


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def _pair_counts(docs: DataFrame, head: object) -> DataFrame:
    """``(a, b, n)`` for neighbouring words that are both in the head."""

    def passed_on(held: Counter) -> pa.RecordBatch:
        columns = [pa.array([p[i] for p in held], pa.binary()).cast(pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.int64())], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, held = head.value.states, Counter()
        for rows in batches:
            for text in rows.column("text"):
                last: list[bytes] = []
                for words in word_blocks(text.as_py(), TABLE):
                    words = last + words
                    held.update(p for p in zip(words, words[1:]) if p[0] in states and p[1] in states)
                    last = words[-1:]
                    if len(held) >= HELD:
                        yield passed_on(held)
                        held = Counter()
        yield passed_on(held)

    return _texts(docs).mapInArrow(run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, runs: int, head: int, buckets: int) -> object:
    """A broadcast ``Head`` of the ``head`` most frequent words and, for longer runs, pairs of them."""
    context = docs.sparkSession.sparkContext
    counts = term_pieces(docs, TABLE).filter(F.octet_length("term") <= HEAD_BYTES).groupBy("term").agg(F.sum("n").alias("n"))
    most = counts.orderBy(F.desc("n"), "term").limit(head)
    words = [r.term.encode() for r in most.select("term").collect()]
    found = context.broadcast(Head(words, [], buckets))
    if runs < 2:
        return found
    pairs = _pair_counts(docs, found).orderBy(F.desc("n"), "a", "b").limit(head).collect()
    return context.broadcast(Head(words, [(r.a.encode(), r.b.encode()) for r in pairs], buckets))


def bucket_totals(docs: DataFrame, head: object, runs: int) -> DataFrame:
    """``(bucket, n)`` over all features of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(head.value.buckets, np.int64)
        for rows in batches:
            for text in rows.column("text"):
                for _, found in head.value.blocks(text.as_py(), runs):
                    totals += np.bincount(found, minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["bucket", "n"])

    return _texts(docs).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, head: object, runs: int, buckets: int) -> np.ndarray:
    """The gain of every bucket: floor(1000 ln of the smoothed target share over the documents' share)."""
    sides = [bucket_totals(part, head, runs).withColumn("side", F.lit(i)) for i, part in enumerate((docs, target))]
    both = sides[0].unionByName(sides[1]).groupBy("bucket").pivot("side", [0, 1]).agg(F.sum("n"))
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(both, "bucket", "left").na.fill(0)
    counted = cut_lineage(every.select("bucket", F.col("0").alias("s"), F.col("1").alias("t")))
    sums = counted.agg(F.sum("s"), F.sum("t")).first()
    s_all, t_all = (F.lit(float(x + buckets)) for x in sums)
    ratio = ((F.col("t") + 1).cast("double") * s_all) / ((F.col("s") + 1).cast("double") * t_all)
    rows = counted.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    out[[r.bucket for r in rows]] = [r.gain for r in rows]
    return out


def _weighed(docs: DataFrame, head: object, gain: object, runs: int) -> DataFrame:
    names = ["doc_id", "n_features", "n_words", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = np.zeros((3, rows.num_rows), np.int64)
            for i in range(rows.num_rows):
                for words, found in head.value.blocks(rows.column("text")[i].as_py(), runs):
                    out[:, i] += len(found), words, gain.value[found].sum()
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *map(pa.array, out)], names)

    return _texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def noise(seed: int, doc_id: Column) -> Column:
    """floor(1000 times a Gumbel variate), from the first 8 hex digits of a SHA-256; a null id counts as ``null``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _places(rows: DataFrame, *order: Column) -> DataFrame:
    """``place`` (from 1) of every row in an order over all rows."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    placed = ranged.withColumn("__part", part).join(F.broadcast(starts), "__part")  # a row for each partition
    return placed.withColumn("place", F.col("__start") + inside + 1).drop("__part", "__start", "__at")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    runs: int = RUNS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    head: int = HEAD,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs (doc_id, text)``, all long.

    ``percent`` of the rows with at least ``min_words`` words are drawn and ranked from 1 by falling score,
    ties by smaller id, null ids last; the others have a null rank. A null or empty text has no
    features and weight 0; a null id takes the noise of the text ``null``; repeated rows are documents of
    their own and follow each other in rank; an empty table of targets gives every bucket the count 0, an
    empty table of documents no rows. Other columns are ignored.
    """
    known = frequent(docs, runs, head, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(docs, target, known, runs, buckets))
    scored = _weighed(docs, known, gain, runs).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id")))
    scored = cut_lineage(scored.withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= min_words
    drawn = percent * scored.filter(able).count() // 100
    ranked = _places(scored.filter(able), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row"))
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest)


#: DuckDB SQL for ``resampled`` with its default options over the tables ``documents`` and ``benchmark``.
RESAMPLED_SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
texts AS (
  SELECT 0 AS side, doc_id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
words AS MATERIALIZED (
  SELECT side, r, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
counted AS MATERIALIZED (SELECT side, r, word, count(*) AS n FROM words GROUP BY ALL),
hexed AS (SELECT DISTINCT word, hex(word) AS h FROM counted),
bytes AS (
  SELECT word, list_concat([4294967295::BIGINT],
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)) AS b FROM hexed),
bucketed AS MATERIALIZED (
  SELECT word, xor(list_reduce(b, lambda c, x: xor(c >> 8, steps[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket
  FROM bytes, crc),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM counted JOIN bucketed USING (word) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM totals),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM totals, sums),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN bucketed USING (word) JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
noisy AS (
  SELECT r, doc_id, floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise FROM texts WHERE side = 0),
scored AS MATERIALIZED (
  SELECT n.r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + noise AS score
  FROM noisy n LEFT JOIN weights w ON n.r = w.r),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored s LEFT JOIN ranked k ON s.r = k.r
"""
