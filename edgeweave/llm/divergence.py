"""How the words of each source differ from the other sources of its language: an audit by count cells.

Terms are runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased. A language keeps the
terms that occur in at least ``min_docs`` of its documents, V in all. Every ``(lang, source)`` group and every
language gives each kept term the smoothed share ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, N the counts'
sum over the kept terms; the divergence of a term is ``f = floor((p - q)^2 / q)``. All of it is integer
arithmetic, in decimals where 64 bits could be too few.

**Cells.** Neither part evaluates f for a term. Terms of a group that agree in ``(group count, lang count)`` are
one cell with a multiplicity; f is evaluated for the cell, cells of equal value are merged, and only values
that begin within the first ``top`` terms by cumulative multiplicity are expanded to terms, in UTF-8 order.

**Pairs.** For two sources the cells are pairs of counts. Only terms that both sources hold are paired, once for
the two directions; terms that one or neither holds follow from each source's own histogram:

    sum f = sum over shared cells  m * (f(a,b) - f(a,0) - f(0,b) + f(0,0))
          + sum over own cells     m * (f(a,0) - f(0,0))
          + sum over other's cells m * (f(0,b) - f(0,0))  +  V * f(0,0)

**One shuffle of terms.** Tasks count the terms of each group piece by piece; the counts are shuffled once, by term and
language, and sorted by their hash. A pass over the sorted rows then adds up equal rows, drops rare terms, and writes the
kept terms together with partial multiplicities of both kinds of cells, so all that follows is as small
as the cells. The pass holds one block of rows and a bounded table of cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from edgeweave.functions.skew import BROADCAST_ROWS
from edgeweave.llm.words import LETTERS, term_pieces, word_table
from edgeweave.session import counted_table, cut_lineage, written_table

SCALE, MIN_DOCS, TOP = 1_000_000_000, 3, 200


def _share(count: str, total: str, terms: str = "terms") -> str:
    """SQL for p, in decimals where the product could pass 63 bits. Without any kept term any divisor does."""
    divisor = f"greatest({total} + {terms}, 1L)"
    wide = f"(cast({SCALE} as decimal(11,0)) * cast({count} + 1 as decimal(20,0))) div cast({divisor} as decimal(20,0))"
    return f"(1 + case when {count} < {SCALE} then ({SCALE}L * ({count} + 1)) div {divisor} else {wide} end)"


def _divergence(p: str, q: str) -> str:
    """SQL for f: at most SCALE squared, which fits a long."""
    return f"((({p} - {q}) * ({p} - {q})) div {q})"


ROWS, PAIRS, HELD = 200_000, 1 << 20, 1 << 20  # rows in a block, pairs formed at once, cells held by a task
_ROW = "kind string, lang string, source string, other string, term string, a long, b long, many long"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


class _Cells:
    """Multiplicities by up to three numbers and a code, held by a task and passed on when there are many."""

    def __init__(self, most: int) -> None:
        self.parts: list[np.ndarray] = []
        self.size, self.most = 0, most

    def add(self, code: np.ndarray, a: np.ndarray, b: np.ndarray, many: np.ndarray | None = None) -> None:
        rows = np.stack([code, a, b, np.ones(len(code), np.int64) if many is None else many])
        self.parts.append(_folded(rows))
        self.size += self.parts[-1].shape[1]

    def full(self) -> bool:
        """After folding what is held, whether it is still too much."""
        if self.size >= self.most:
            self.parts = [_folded(np.concatenate(self.parts, axis=1))]
            self.size = self.parts[0].shape[1]
        return self.size >= self.most // 2

    def taken(self) -> np.ndarray:
        out = _folded(np.concatenate([np.zeros((4, 0), np.int64), *self.parts], axis=1))
        self.parts, self.size = [], 0
        return out


def _folded(rows: np.ndarray) -> np.ndarray:
    """Columns ``(code, a, b, many)`` with equal first three added up."""
    if not rows.shape[1]:
        return rows
    rows = rows[:, np.lexsort(rows[2::-1])]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return np.concatenate([rows[:3, first], np.add.reduceat(rows[3], first)[None]])


def _places(column: pa.Array) -> np.ndarray:
    """For each value its place among the distinct ones, in the order of their bytes."""
    coded = column.dictionary_encode()
    order = pa.compute.array_sort_indices(coded.dictionary.cast(pa.binary())).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()]


def _changes(*columns: pa.Array) -> np.ndarray:
    """Where a row differs from the one before in any column."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        codes = c.dictionary_encode().indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _paired(group: np.ndarray, n: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(code, a, b)`` of every two rows that end at the same place, some at a time."""
    partners = ends - np.arange(len(ends)) - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(partners):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        count = partners[at:stop]
        one = np.repeat(np.arange(at, stop), count)
        two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count)
        yield group[one] << 32 | group[two], n[one], n[two]
        at = stop


def counted_cells(pieces: DataFrame, min_docs: int, block_rows: int = ROWS, pair_rows: int = PAIRS, held_cells: int = HELD) -> DataFrame:
    """From partial counts ``(lang, source, term, n, docs)`` the kept terms and the cells, as rows of kinds.

    ``term`` has ``(lang, source, term, a = n, b = lang's n)``, ``cell`` the multiplicity of ``(lang, source, a, b)``,
    ``pair`` that of ``(lang, source, other, a, b)`` with source below other, and ``lang`` the number of
    terms; all but ``term`` are partial. Equal terms of a language meet in one task and one block, by their hash.
    The last three arguments bound what a task holds; they change partial rows only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[str, str], int] = {}
        cells, pairs, langs = _Cells(held_cells), _Cells(held_cells), {}

        def sent(kind: str, found: np.ndarray, both: bool) -> pa.RecordBatch:
            names = list(codes) or [("", "")]
            first = found[0] >> 32 if both else found[0]
            text = lambda at, place: pa.array([n[place] for n in names], pa.string()).take(pa.array(at))
            other = text(found[0] & 0xFFFFFFFF, 1) if both else pa.nulls(len(first), pa.string())
            columns = [pa.array([kind] * len(first), pa.string()), text(first, 0), text(first, 1), other, pa.nulls(len(first), pa.string())]
            return pa.RecordBatch.from_arrays([*columns, *map(pa.array, found[1:])], _NAMES)

        def block(rows: pa.Table, last: bool) -> tuple[pa.Table, list[pa.RecordBatch]]:
            """What is left for the next block (an unfinished term), and the rows to send."""
            rows = rows.combine_chunks()
            lang, source, term = (rows.column(c).combine_chunks() for c in ("lang", "source", "term"))
            h, n, docs = (rows.column(c).to_numpy() for c in ("h", "n", "docs"))
            order = np.lexsort([_places(source), _places(lang), _places(term), h])
            pick = pa.array(order)
            h, n, docs = h[order], n[order], docs[order]
            lang, source, term = lang.take(pick), source.take(pick), term.take(pick)
            first = np.flatnonzero(_changes(term, lang, source))
            h, n, docs = h[first], np.add.reduceat(n, first), np.add.reduceat(docs, first)
            pick = pa.array(first)
            lang, source, term = lang.take(pick), source.take(pick), term.take(pick)
            begins = np.flatnonzero(_changes(term, lang))
            whole = {"h": h, "lang": lang, "source": source, "term": term, "n": n, "docs": docs}
            rest = pa.Table.from_arrays([pa.array(whole[c]) for c in rows.column_names], schema=rows.schema)
            if not last:  # more rows of the last hash may follow
                cut = int(np.searchsorted(h, h[-1]))
                rest, begins = rest.slice(cut), begins[begins < cut]
                lang, source, term, n, docs = lang[:cut], source[:cut], term[:cut], n[:cut], docs[:cut]
            if not len(begins):
                return rest, []
            sizes = np.diff(np.append(begins, len(n)))
            held = np.add.reduceat(docs, begins) >= min_docs
            keep = np.flatnonzero(np.repeat(held, sizes))
            total = np.repeat(np.add.reduceat(n, begins), sizes)[keep]
            pick = pa.array(keep)
            lang, source, term, n = lang.take(pick), source.take(pick), term.take(pick), n[keep]
            named = [codes.setdefault(k, len(codes)) for k in zip(lang.to_pylist(), source.to_pylist())]
            group = np.array(named, np.int64)
            ends = np.repeat(np.cumsum(sizes[held]), sizes[held])
            cells.add(group, n, total)
            for part in _paired(group, n, ends, pair_rows):
                pairs.add(*part)
            for name in lang.take(pa.array(np.flatnonzero(np.diff(np.concatenate(([-1], ends)))))).to_pylist():
                langs[name] = langs.get(name, 0) + 1
            kind = pa.array(["term"] * len(keep), pa.string())
            none = pa.nulls(len(keep), pa.string())
            out = [pa.RecordBatch.from_arrays([kind, lang, source, none, term, pa.array(n), pa.array(total), pa.nulls(len(keep), pa.int64())], _NAMES)]
            if cells.full():
                out.append(sent("cell", cells.taken(), False))
            if pairs.full():
                out.append(sent("pair", pairs.taken(), True))
            return rest, out

        waiting: list[pa.Table] = []
        size = 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            size += len(batch)
            if size >= block_rows:
                rest, out = block(pa.concat_tables(waiting), False)
                yield from out
                waiting, size = [rest], len(rest)
        if size:
            yield from block(pa.concat_tables(waiting), True)[1]
        yield sent("cell", cells.taken(), False)
        yield sent("pair", pairs.taken(), True)
        if langs:
            none = pa.nulls(len(langs), pa.string())
            many = pa.array(list(langs.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(["lang"] * len(langs)), pa.array(list(langs)), none, none, none, many, many, many], _NAMES)

    # sorted by a hash only, one number; the pass puts the few rows of a hash in order
    dealt = pieces.withColumn("h", F.xxhash64("term", "lang")).repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, _ROW)


def _of(found: DataFrame, kind: str, **columns: str) -> DataFrame:
    return found.filter(F.col("kind") == kind).select(*[F.col(old).alias(new) for new, old in columns.items()])


def _groups(docs: DataFrame, cells: DataFrame, langs: DataFrame) -> DataFrame:
    """``(lang, source, total, lang_total, terms)`` for every group that occurs, also without any kept term."""
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("many")).alias("total"))
    whole = own.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    joined = every.join(own, ["lang", "source"], "left").join(whole, "lang", "left").join(langs, "lang", "left")
    return cut_lineage(joined.na.fill(0, ["total", "lang_total", "terms"]))


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def term_divergence(terms: DataFrame, cells: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``(lang, source, item, value, rank)``: a group's ``top`` terms with a larger share than in the language."""
    group, cell = ["lang", "source"], ["lang", "source", "n", "lang_n"]
    shares = {"p": F.expr(_share("n", "total")), "q": F.expr(_share("lang_n", "lang_total"))}
    valued = cells.join(groups, group).withColumns(shares).filter("p > q")
    valued = cut_lineage(valued.select(*cell, "many", F.expr(_divergence("p", "q")).alias("value")))
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    merged = valued.groupBy(*group, "value").agg(F.sum("many").alias("many"))
    merged = merged.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= top)
    before = F.coalesce(F.sum("many").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = merged.withColumn("before", before).filter(F.col("before") < top).select(*group, "value")
    chosen, _, size = counted_table(valued.join(chosen, [*group, "value"]).select(*cell, "value"), "chosen-cells")
    chosen = F.broadcast(chosen) if size <= BROADCAST_ROWS else chosen
    expanded = terms.join(chosen, cell).select(*group, F.col("term").alias("item"), "value")
    return _ranked(expanded, top)


def source_divergence(pairs: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value, rank)``: every other source of the language, by the sum of f over all kept terms."""

    def side(name: str) -> DataFrame:
        return groups.select("lang", F.col("source").alias(name), F.col("total").alias(f"{name}_total"), "terms")

    def shared_out(rows: DataFrame, *counts: str) -> DataFrame:
        """Shares of 0 and of the counts, ``s_0`` and so on, worked out once a row."""
        told = [(who, c) for who in "so" for c in ("0L", *counts)]
        return rows.withColumns({f"{who}_{c[0]}": F.expr(_share(c, f"{who}_total")) for who, c in told})

    def times_many(*signed: tuple[str, str, str]) -> str:
        """The multiplicity times a signed sum of up to four values, which fits a long."""
        found = " ".join(f"{sign} {_divergence(p, q)}" for sign, p, q in signed)
        return f"cast(many as decimal(20,0)) * cast(({found}) as decimal(20,0))"

    def both_ways(forward: str, backward: str) -> F.Column:
        items = [F.struct(F.col(x).alias("source"), F.col(y).alias("item"), F.expr(v).alias("value")) for x, y, v in (("s", "o", forward), ("o", "s", backward))]
        return F.inline(F.array(*items))

    def beyond(one: str, other: str, a: str, b: str) -> str:
        p, p0, q, q0 = f"{one}_{a}", f"{one}_0", f"{other}_{b}", f"{other}_0"
        return times_many(("+", p, q), ("-", p, q0), ("-", p0, q), ("+", p0, q0))

    s, o = side("s"), side("o").drop("terms")
    both = shared_out(pairs.join(s, ["lang", "s"]).join(o, ["lang", "o"]), "a", "b")
    shared = both.select("lang", both_ways(beyond("s", "o", "a", "b"), beyond("o", "s", "b", "a")))

    own = cells.groupBy("lang", F.col("source").alias("s"), F.col("n").alias("a")).agg(F.sum("many").alias("many"))
    own = shared_out(own.join(s, ["lang", "s"]).join(o, "lang").filter("s <> o"), "a")
    forward = times_many(("+", "s_a", "o_0"), ("-", "s_0", "o_0"))
    backward = times_many(("+", "o_0", "s_a"), ("-", "o_0", "s_0"))
    alone = own.select("lang", both_ways(forward, backward))

    none = s.join(o, "lang").filter("s <> o")
    none = shared_out(none).withColumn("many", F.col("terms"))
    none = none.select("lang", F.col("s").alias("source"), F.col("o").alias("item"), F.expr(times_many(("+", "s_0", "o_0"))).alias("value"))
    summed = shared.unionByName(alone).unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return _ranked(summed, None)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for ``docs (text, lang, source)``.

    Part ``pair`` has every other source of the language as item, all ranks; part ``term`` the terms with
    a larger share in the group than in the language, ranks to ``top``. Values fall, ties go by UTF-8.
    Null text, lang and source count as empty strings; every row is a document of its own, also a
    repeated one; a group without terms has shares of zero counts; a language without kept terms has
    pairs of value 0 and no terms; an empty table gives no rows. Other columns are ignored.
    """
    pieces = term_pieces(docs, word_table(LETTERS), ("lang", "source"))
    found, _ = written_table(counted_cells(pieces, min_docs), "cells")
    summed = lambda df: df.groupBy(*[c for c in df.columns if c != "many"]).agg(F.sum("many").alias("many"))
    cells = cut_lineage(summed(_of(found, "cell", lang="lang", source="source", n="a", lang_n="b", many="many")))
    pairs = summed(_of(found, "pair", lang="lang", s="source", o="other", a="a", b="b", many="many"))
    langs = summed(_of(found, "lang", lang="lang", many="many")).withColumnRenamed("many", "terms")
    terms = _of(found, "term", lang="lang", source="source", term="term", n="a", lang_n="b")
    groups = _groups(docs, cells, langs)
    parts = {"pair": source_divergence(pairs, cells, groups), "term": term_divergence(terms, cells, groups, top)}
    columns = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts.items()]
    return columns[0].unionByName(columns[1])


#: DuckDB SQL for ``audit`` over the table ``documents``, every share and value spelt out for every term.
AUDIT_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM words GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 3),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*) AS terms FROM kept GROUP BY ALL),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
full_counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM full_counts GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000::HUGEINT * (c.n + 1)) // (t.total + l.terms) AS p,
         1 + (1000000000::HUGEINT * (c.lang_n + 1)) // (l.total + l.terms) AS q
  FROM full_counts c JOIN totals t ON t.lang = c.lang AND t.source = c.source JOIN langs l ON l.lang = c.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term WHERE a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
