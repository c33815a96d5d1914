"""URL verdicts: host and path rules first, else logistic regression on hashed character n-grams.

All of it is DataFrame functions. The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A-Z lower-cased; the path follows it up to ``?``, ``#`` or the end. The features of a URL are the
3- and 4-grams of ``<host>`` and of the path, each hashed (md5) to one of ``buckets`` classes, counted
and divided by the square root of their number. Training is gradient descent over a small labelled
table that is collected into one row: an ``aggregate`` over the steps carries the weights, so the
table must be small (``MAX_LABELLED`` rows, more are an error). The weights, one double a class, are the
only thing that reaches the driver, and a page is scored where it is read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS, STEPS, RATE, DECAY, MAX_LABELLED = 512, 150, 0.5, 0.001, 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The labelled URLs (1: to be blocked) that the query trains on.
LABELLED = [
    ("http://www.cheap-pills.example.com/en/450?page=2", 1),
    ("https://buy-cheap-pills.example.net/order/now", 1),
    ("http://pills-online.example.com/fr/12", 1),
    ("https://m.casino-win.example.com/en/31", 1),
    ("http://casino-win.example.net/es/844.html", 1),
    ("https://royal-casino.example.com/win/big", 1),
    ("https://free-bets.example.com/en/9", 1),
    ("http://blog.free-bets.example.net/de/77/", 1),
    ("https://best-free-bets.example.com/bets", 1),
    ("https://m.ads-track.example.com/en/518", 1),
    ("http://ads-track.example.net/click?id=4", 1),
    ("http://track-ads.example.com/pixel", 1),
    ("https://spam-farm.example.org/en/728", 1),
    ("http://www.spam-farm.example.com/es/3", 1),
    ("https://link-spam.example.net/farm/9", 1),
    ("http://win-prizes.example.com/free", 1),
    ("http://adult-x.example.com/en/606", 1),
    ("https://www.adult-x.example.net/es/18?ref=x", 1),
    ("https://ththin.example.com/en/671?utm_source=feed", 0),
    ("http://blog.ththan.example.net/en/369#top", 0),
    ("https://www.ththen.example.com/en/148.html", 0),
    ("https://blog.thertion.example.org/es/978?page=2", 0),
    ("https://m.therou.example.com/en/474.html", 0),
    ("http://tionble.example.org/en/453#top", 0),
    ("https://tiontion.example.net/es/797", 0),
    ("https://blog.tionsh.example.net/de/612", 0),
    ("http://thering.example.com/fr/328/", 0),
    ("https://www.theron.example.net/en/334/", 0),
    ("https://m.ththes.example.com/de/925", 0),
    ("https://news.example.com/en/2024/article.html", 0),
    ("http://www.library.example.net/fr/catalogue", 0),
    ("https://docs.example.com/es/guide/12", 0),
    ("https://m.weather.example.net/de/today", 0),
    ("http://school.example.com/en/history/5", 0),
    ("https://blog.garden.example.net/fr/roses", 0),
    ("https://ththwh.example.com/en/101", 0),
    ("", 0),
]


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        same = (host == self.host) | F.endswith(host, F.lit("." + self.host))
        return same & F.startswith(path, F.lit(self.path))


# The rules of the query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _grams(text: Column, size: int, tag: str) -> Column:
    count = F.length(text) - (size - 1)
    found = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat(F.lit(tag), F.substring(text, i, F.lit(size))))
    return F.when(count > 0, found).otherwise(F.array().cast("array<string>"))


def features(host: Column, path: Column, buckets: int) -> Column:
    """The class of every n-gram, repeats included."""
    around = F.when(host != "", F.concat(F.lit("<"), host, F.lit(">"))).otherwise("")
    grams = F.concat(*(_grams(t, n, tag) for t, tag in ((around, "h"), (path, "p")) for n in (3, 4)))
    return F.transform(grams, lambda g: F.conv(F.substring(F.md5(g), 1, 6), 16, 10).cast("int") % buckets)


def _logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _model_row(labelled: DataFrame, buckets: int, steps: int) -> DataFrame:
    """One row with the weights of all classes and, last, the bias."""
    host, path = host_and_path(F.col("url"))
    found = labelled.filter(F.col("label").isin(0, 1)).select(
        F.col("label").cast("double").alias("y"), F.coalesce("url", F.lit("")).alias("url"), features(host, path, buckets).alias("f")
    )
    scale = F.sqrt(F.greatest(F.size("f"), F.lit(1)).cast("double"))

    def dense(j: Column) -> Column:
        count = F.size(F.filter("f", lambda i: i == j)).cast("double")
        return F.when(j == buckets, F.lit(1.0)).otherwise(count / scale)

    found = found.withColumn("x", F.transform(F.sequence(F.lit(0), F.lit(buckets)), dense))
    table = found.agg(F.sort_array(F.collect_list(F.struct("url", "y", "x"))).alias("rows"))
    rows = F.col("rows")

    def step(w: Column, _: Column) -> Column:
        def error(r: Column) -> Column:
            used = F.zip_with(r["x"], w, lambda a, b: a * b)
            return F.struct((_logistic(F.aggregate(used, F.lit(0.0), lambda s, v: s + v)) - r["y"]).alias("e"), r["x"].alias("x"))

        def stepped(errors: Column) -> Column:
            def one(v: Column, j: Column) -> Column:
                slope = F.aggregate(errors, F.lit(0.0), lambda s, r: s + r["e"] * F.get(r["x"], j))
                return v * (1 - RATE * DECAY) - RATE * slope

            return F.transform(w, one)

        # a one-element array holds the errors, so that they are computed once a step
        held = F.transform(F.array(F.transform(rows, error)), stepped)
        return F.get(held, F.lit(0))

    start = F.array_repeat(F.lit(0.0), buckets + 1)
    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("w"))


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS) -> list[float]:
    """Weights of the classes and the bias, from ``labelled (url, label)``.

    Labels other than 0 and 1 teach nothing; without any row all weights are zero.
    """
    if labelled.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs; collecting them is meant for a small table")
    return list(_model_row(labelled, buckets, steps).first()["w"])


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in LABELLED))
    return spark.range(1).select(F.inline(rows))


def judged(pages: DataFrame, weights: list[float], rules: list[Rule]) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages (page_id, url)``.

    The longest fitting rule gives the verdict; without one, a URL is blocked when its probability
    is at least one half. Null URLs and those without ``://`` have an empty host and path, which the
    model judges by its bias. Repeated rows and null ids stay; an empty table gives no rows; columns
    beyond the two are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    w = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded into one constant
    found = features(F.col("host"), F.col("path"), len(weights) - 1)
    rows = rows.withColumn("found", found)
    total = F.aggregate("found", F.lit(0.0), lambda s, i: s + F.get(w, i))
    logit = total / F.sqrt(F.greatest(F.size("found"), F.lit(1)).cast("double")) + F.lit(weights[-1])
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    rule, verdict = F.lit(None).cast("string"), F.when(logit >= 0, "block").otherwise("allow")
    for r in reversed(ranked):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def url_verdicts(pages: DataFrame, rules: list[Rule] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``judged`` with a model trained on ``labelled (url, label)``, by default ``LABELLED``."""
    return judged(pages, train(labelled_urls(pages.sparkSession) if labelled is None else labelled), rules)


def _features_sql(url: str) -> str:
    """DuckDB select of host, path and the n-gram classes from rows that have ``url``."""
    grams = " || ".join(
        f"list_transform(range(1, greatest(length({t}) - {n - 2}, 1)), lambda i: '{tag}' || substr({t}, i, {n}))"
        for t, tag in (("around", "h"), ("path", "p"))
        for n in (3, 4)
    )
    return f"""
  SELECT * EXCLUDE (rest, around), list_transform({grams}, lambda g: ('0x' || substr(md5(g), 1, 6))::INTEGER % {BUCKETS}) AS f
  FROM (SELECT *, CASE WHEN host <> '' THEN '<' || host || '>' ELSE '' END AS around
        FROM (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
              FROM (SELECT *, CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) ELSE '' END AS rest
                    FROM source_rows)))"""


def url_verdicts_sql() -> str:
    """DuckDB SQL for ``url_verdicts`` with its defaults over ``pages``."""
    known = ", ".join(f"('{u}', {y}.0::DOUBLE)" for u, y in LABELLED)
    ranked = sorted(RULES, key=lambda r: (-len(r.name), r.name))
    fits = {r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ranked}
    names = " ".join(f"WHEN {fits[r]} THEN '{r.name}'" for r in ranked)
    verdicts = " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in ranked)
    return f"""
WITH RECURSIVE known AS (
  WITH source_rows AS (SELECT * FROM (VALUES {known}) t(url, y)) {_features_sql("url")}),
dense AS MATERIALIZED (
  SELECT list(list_transform(range({BUCKETS}), lambda j: len(list_filter(f, lambda i: i = j)) / sqrt(greatest(len(f), 1)::DOUBLE))
              || [1.0::DOUBLE] ORDER BY url, y) AS xs, list(y ORDER BY url, y) AS ys FROM known),
trained(step, w) AS (
  SELECT 0, list_transform(range({BUCKETS + 1}), lambda j: 0.0::DOUBLE)
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, j: v * (1 - {RATE} * {DECAY})
           - {RATE} * list_sum(list_transform(es, lambda e, r: e * xs[r][j])))
  FROM (SELECT step, w, xs, list_transform(xs, lambda x, r: 1 / (1 + exp(-list_inner_product(x, w))) - ys[r]) AS es
        FROM trained, dense WHERE step < {STEPS})),
model AS (SELECT w FROM trained WHERE step = {STEPS}),
judged AS (WITH source_rows AS (SELECT page_id, url FROM pages) {_features_sql("url")})
SELECT page_id, host, path, CASE {names} ELSE NULL END AS rule,
       CASE {verdicts}
            WHEN coalesce(list_sum(list_transform(f, lambda i: w[i + 1])), 0) / sqrt(greatest(len(f), 1)::DOUBLE)
                 + w[{BUCKETS + 1}] >= 0 THEN 'block' ELSE 'allow' END AS verdict
FROM judged, model
"""
