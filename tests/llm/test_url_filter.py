import hashlib
import math
import re

import numpy as np
import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave.llm import queries, url_filter

ODD = [
    (1, "HTTP://WWW.Spam-Farm.EXAMPLE.org/es/1?x=/es/#y"),
    (2, "https://example.org/en/1"),
    (3, "https://example.org/en/2"),
    (4, "https://badexample.org"),
    (5, "https://a.b.com/fr/://x/de/"),
    (6, "http://com/de/?q"),
    (7, "https://xcom/de/"),
    (8, None),
    (9, ""),
    (10, "no scheme /a"),
    (11, "x://"),
    (12, "x://?a/b"),
    (13, "x://h#f/p"),
    (None, "x://org/"),
    (2, "https://example.org/en/1"),
    (14, "é://ÀB.example.org/es/ü\nline" + "z" * 5000),
    (15, "https://org.evil.net/es/"),
    (16, "a://b://c/d"),
]


def plain_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def plain_features(url):
    host, path = plain_parts(url)
    around = f"<{host}>" if host else ""
    grams = [t + s[i : i + n] for s, t in ((around, "h"), (path, "p")) for n in (3, 4) for i in range(len(s) - n + 1)]
    x = np.zeros(513)
    for g in grams:
        x[int(hashlib.md5(g.encode()).hexdigest()[:6], 16) % 512] += 1 / math.sqrt(len(grams))
    x[512] = 1
    return x


@pytest.fixture(scope="module")
def weights(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_training_matches_plain_descent(weights):
    x = np.array([plain_features(u) for u, _ in url_filter.LABELLED])
    y = np.array([label for _, label in url_filter.LABELLED])
    w = np.zeros(513)
    for _ in range(url_filter.STEPS):
        w = w * (1 - url_filter.RATE * url_filter.DECAY) - url_filter.RATE * ((1 / (1 + np.exp(-x @ w)) - y) @ x)
    assert weights == pytest.approx(w.tolist(), abs=1e-9)
    assert ((x @ w >= 0) == (y == 1)).all()


def test_verdicts(spark, weights):
    pages = spark.createDataFrame([(i, u, "own", "x") for i, u in ODD], "page_id long, url string, host string, verdict string")
    got = sorted((tuple(r) for r in url_filter.judged(pages, weights, url_filter.RULES).collect()), key=str)
    want = []
    for page, url in ODD:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        model = "block" if plain_features(url) @ np.array(weights) >= 0 else "allow"
        want.append((page, host, path, rule and rule.name, rule.verdict if rule else model))
    assert got == sorted(want, key=str)


def test_spam_hosts_that_were_not_seen(spark, weights):
    urls = ["http://www.cheap-pills.example.net/en/3", "https://online-casino.example.com/en/9", "http://m.tionth.example.net/en/9"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert [r.verdict for r in url_filter.judged(pages, weights, []).orderBy("page_id").collect()] == ["block", "block", "allow"]


def test_odd_labels(spark):
    assert set(url_filter.train(spark.createDataFrame([], "url string, label int"))) == {0.0}
    rows = spark.createDataFrame([(None, 1), ("x://a", None), ("x://a", 7)], "url string, label int")
    assert url_filter.train(rows, steps=5)[-1] > 0
    with pytest.raises(ValueError, match="small table"):
        url_filter.train(spark.range(2000).selectExpr("'x://a' AS url", "1 AS label"))


def test_query_matches_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op7_url_verdicts"
    assert spark_bag(queries.queries()[name](spark, sf)) == sql_bag(connect(sf), queries.oracle_sql()[name])


def test_no_python_in_the_plan(spark, weights):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_filter.judged(pages, weights, url_filter.RULES)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.url_verdicts(pages).collect() == []
