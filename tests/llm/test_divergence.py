from collections import Counter, defaultdict
import re

import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import divergence, queries, words

SF = "/root/testdata/sf0.001"
SCHEMA = "text string, lang string, source string, term string, value long, rank int"
ODD = [
    ("Cat cat dog 12cat_dog", "en", "a", "x", 1, 1),
    ("cat bird Ünder über", "en", "b", "x", 1, 1),
    ("cat dog ÜBER über", "en", "b", "x", 1, 1),
    ("dog über\x00über|éa é", "en", None, "x", 1, 1),
    ("cat dog", "en", "a", None, None, None),
    ("cat dog", "en", "a", None, None, None),
    (None, "en", "c", "x", 1, 1),
    ("", "en", "c", "x", 1, 1),
    ("lonely words", "fr", "a", "x", 1, 1),
    (None, "fr", "b", "x", 1, 1),
    ("null null null", None, None, "x", 1, 1),
    ("null", None, "a", "x", 1, 1),
    ("null z", None, "a", "x", 1, 1),
    ("word " * 300_000 + "long" * 400_000, "de", "big", "x", 1, 1),
    ("word", "de", "small", "x", 1, 1),
    ("word \U0001d400x", "de", "small", "x", 1, 1),
]


def plain_audit(rows, min_docs=3, top=200):
    """Every share of every term, one by one."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        own = {s: [counts[lang, s][t] for t in kept] for s in sources}
        whole = [sum(own[s][i] for s in sources) for i in range(len(kept))]
        share = lambda c: [1 + 10**9 * (x + 1) // (sum(c) + len(kept)) for x in c]
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            found = {"pair": [], "term": []}
            for other in sources:
                if other != s:
                    found["pair"].append((other, sum(map(f, share(own[s]), share(own[other])))))
            for t, n, p, q in zip(kept, own[s], share(own[s]), share(whole)):
                if n and p > q:
                    found["term"].append((t, f(p, q)))
            for part, items in found.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return Counter(out)


def got(frame):
    return Counter(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(5)
    assert got(divergence.audit(docs)) == plain_audit([r[:3] for r in ODD])


def test_no_term_is_kept(spark):
    docs = spark.createDataFrame([("one", "en", "a"), ("two", "en", "b")], "text string, lang string, source string")
    assert got(divergence.audit(docs)) == Counter([("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(docs).collect() == []


@pytest.mark.parametrize("top", [1, 3, 200])
def test_large_cells_and_ties(spark, top):
    """Many terms share a cell, cells share a value, and the last value is cut in UTF-8 order."""
    rows = [(" ".join(f"{c}{d}" for c in "abcdefghij" for d in "zyxwvé"), "en", s) for s in "pqr"]
    rows += [("rare " * 3 + " ".join("klmno"), "en", "p")] * 3 + [("uno due", "en", "q")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(docs, top=top)) == plain_audit(rows, top=top)


@pytest.mark.parametrize("size", [1, 7, 60])
def test_small_blocks(spark, size):
    """Pieces of text, blocks of rows, pairs and held cells of any size give the same rows."""
    rows = [r[:3] for r in ODD[:-3]] + [(" ".join(f"w{i % k}" for i in range(k)).replace("1", "a").replace("2", "b"), "en", f"s{k}") for k in range(2, 12)] * 2
    docs = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    pieces = words.term_pieces(docs, words.word_table(words.LETTERS), ("lang", "source"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        small = divergence.counted_cells(pieces.unionByName(pieces), 3, size, size, 2 * size).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    usual = divergence.counted_cells(pieces.unionByName(pieces), 3).collect()

    def totals(found):
        out = Counter()
        for r in found:
            out[r[:7]] += 1 if r.kind == "term" else r.many
        return out

    def whole(found):
        """Totals with the language's rows, whose other numbers are partial, by name only."""
        out = Counter()
        for key, many in totals(found).items():
            out[key if key[0] != "lang" else key[:2]] += many
        return out

    assert whole(small) == whole(usual)


def test_counts_beyond_64_bits(spark):
    """A count of some billions times a thousand million needs more than a long."""
    big = 1 << 40
    pairs = spark.createDataFrame([("en", "a", "b", big, 5, 1)], "lang string, s string, o string, a long, b long, many long")
    cells = spark.createDataFrame(
        [("en", "a", big, big + 5, 1), ("en", "b", 5, big + 5, 1), ("en", "b", 7, 7, 1)],
        "lang string, source string, n long, lang_n long, many long",
    )
    groups = spark.createDataFrame([("en", "a", big, big + 12, 2), ("en", "b", 12, big + 12, 2)], "lang string, source string, total long, lang_total long, terms long")
    share = lambda c, n: 1 + 10**9 * (c + 1) // (n + 2)
    f = lambda p, q: (p - q) ** 2 // q
    a, b = [share(big, big), share(0, big)], [share(5, 12), share(7, 12)]
    want = {("a", "b"): sum(map(f, a, b)), ("b", "a"): sum(map(f, b, a))}
    assert {(r.source, r.item): r.value for r in divergence.source_divergence(pairs, cells, groups).collect()} == want


def test_query_matches_sql(spark):
    got_columns, have = spark_bag(queries.op13_count_cell_audit(spark, SF))
    want_columns, want = sql_bag(connect(SF), queries.oracle_sql()["op13_count_cell_audit"])
    assert got_columns == want_columns
    assert have == want and have
