from collections import Counter
import hashlib
import math

import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import mixing, queries


def plain_mixture(rows, a, ratio, seed=17):
    """Rows (doc_id, source, text) to taken (doc_id, source, tokens, epoch, place)."""
    counted = [(d, s, len([w for w in (t or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w])) for d, s, t in rows]
    sizes = Counter()
    for _, s, n in counted:
        sizes[s] += n
    total = sum(sizes.values())
    powers = {s: (n / total) ** a for s, n in sizes.items() if n}
    out = []
    for s, p in powers.items():
        budget = math.floor(p / sum(powers.values()) * total * ratio)
        for epoch in range(budget // sizes[s] + 1):
            left = sizes[s] if epoch < budget // sizes[s] else budget % sizes[s]
            key = lambda r: (hashlib.md5(f"{seed}|{epoch}|{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
            place = 0
            for d, _, n in sorted((r for r in counted if r[1] == s), key=key):
                if place < left or epoch < budget // sizes[s]:
                    out.append((d, s, n, epoch, place))
                place += n
    return Counter(out)


ROWS = (
    [(i, "big", "word " * (i % 7 + 1)) for i in range(300)]
    + [(i, "small", "a\tb\x0bc") for i in range(300, 320)]
    + [(i, None, "no source here") for i in range(400, 410)]
    + [(500, "none", ""), (501, "none", None), (None, "big", "x y"), (7, "big", "word"), (7, "big", "word")]
)


def frame(spark, rows):
    return spark.createDataFrame([(d, s, t, "x") for d, s, t in rows], "doc_id long, source string, text string, epoch string")


def found_exponent(spark, rows, **options):
    counted = frame(spark, rows).select("source", mixing.token_count(mixing.F.col("text")).alias("tokens"))
    sizes = counted.groupBy("source").agg(mixing.F.sum("tokens").alias("t")).filter("t > 0")
    total = sizes.agg(mixing.F.sum("t")).first()[0]
    return mixing.exponent(sizes.select((mixing.F.col("t") / total).alias("share")), **options)


@pytest.mark.parametrize("block_docs", [4096, 3])
@pytest.mark.parametrize("target", [{"entropy": 0.9, "repeats": None}, {"entropy": None, "repeats": 2.0}, {"entropy": None, "repeats": None}])
def test_mixture_matches_brute_force(spark, target, block_docs):
    a = found_exponent(spark, ROWS, ratio=1.3, **target)
    got = mixing.mixture(frame(spark, ROWS), ratio=1.3, block_docs=block_docs, **target)
    assert Counter(tuple(r) for r in got.collect()) == plain_mixture(ROWS, a, 1.3)


def test_targets_are_met(spark):
    shares = [0.7, 0.2, 0.06, 0.04]
    table = spark.createDataFrame([(s,) for s in shares], "share double")

    def weights(a):
        z = sum(s**a for s in shares)
        return [s**a / z for s in shares]

    a = mixing.exponent(table, 1.0, 0.8, None)
    assert -sum(w * math.log(w) for w in weights(a)) == pytest.approx(0.8 * math.log(4), abs=1e-6)
    a = mixing.exponent(table, 1.0, None, 2.5)
    assert max(w / s for w, s in zip(weights(a), shares)) == pytest.approx(2.5, abs=1e-6)
    assert mixing.exponent(table, 1.0, 0.1, None) == 1.0  # met as it is
    assert mixing.exponent(table, 1.0, None, 100.0) == 0.0
    one = spark.createDataFrame([(1.0,)], "share double")
    assert mixing.exponent(one, 1.0, 0.9, None) == 1.0


def test_mixed_documents_keep_rows_and_columns(spark):
    docs = frame(spark, ROWS)
    got = mixing.mixed_documents(docs, ratio=1.3)
    want = Counter()
    for (d, s, n, _, _), k in plain_mixture(ROWS, found_exponent(spark, ROWS, ratio=1.3, entropy=0.9, repeats=None), 1.3).items():
        want[d, s, n] += k
    rows = got.withColumn("n", mixing.token_count(mixing.F.col("text"))).collect()
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.source, r.n) for r in rows) == want


def test_empty(spark):
    docs = frame(spark, ROWS).limit(0)
    assert mixing.mixture(docs).collect() == []
    assert mixing.mixed_documents(docs).collect() == []


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = spark_bag(queries.queries()["op4_temperature_mixing"](spark, sf))
    assert got == sql_bag(connect(sf), queries.oracle_sql()["op4_temperature_mixing"])


def test_no_python_in_the_plan(spark):
    plan = mixing.mixture(frame(spark, ROWS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_tiny_source_without_a_limit_runs_in_pieces(spark):
    """One document of a token beside very many tokens: its epochs are far more than an array should hold."""
    docs = spark.createDataFrame([(1, "tiny", "a"), (2, "large", "w " * 60_000)], "doc_id long, source string, text string")
    free = mixing.mixture(docs, entropy=1.0, repeats=None).filter("source = 'tiny'")
    assert free.agg(mixing.F.count("*"), mixing.F.countDistinct("epoch"), mixing.F.max("epoch")).first()[:] == (30_000, 30_000, 29_999)
    held = mixing.mixture(docs, entropy=1.0).filter("source = 'tiny'").count()
    assert mixing.REPEATS - 1 <= held <= mixing.REPEATS + 1


@pytest.mark.parametrize("block_docs", [4096, 3])
def test_copies_and_null_ids_fold(spark, block_docs):
    """A third of the rows are copies of one document or have no id; they are placed one after the other."""
    rows = [(1, "big", "a b c")] * 500 + [(None, "big", "x " * (i % 5)) for i in range(500)] + [(i, "big", "a b") for i in range(10, 500)]
    rows += [(i, "small", "a b c") for i in range(1000, 1030)]
    a = found_exponent(spark, rows, ratio=1.7, entropy=0.9, repeats=None)
    got = mixing.mixture(frame(spark, rows), ratio=1.7, block_docs=block_docs, repeats=None)
    assert Counter(tuple(r) for r in got.collect()) == plain_mixture(rows, a, 1.7)


def test_unrolling(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 3)
    counts = {1: 0, 2: 1, 3: 3, 4: 4, 5: 26}
    rows = spark.createDataFrame(list(counts.items()), "k long, n long")
    for apart in (None, ["k"]):
        got = Counter(r.k for r in mixing._unrolled(rows, mixing.F.col("n"), "i", apart).collect())
        assert got == {k: n for k, n in counts.items() if n}
    assert sorted(r.i for r in mixing._unrolled(rows, mixing.F.col("n"), "i", ["k"]).filter("k = 5").collect()) == list(range(26))


def test_clashing_names(spark):
    names = ["__size", "__turn", "__rows", "__copies", "__share", "__copy", "__doc_id", "row", "size", "rows", "mixed", "share", "copy"]
    docs = spark.createDataFrame([(1, "s", "a b", *range(len(names)))], ["doc_id", "source", "text", *names])
    assert [tuple(r) for r in mixing.mixed_documents(docs).collect()] == [(1, "s", "a b", *range(len(names)))]
