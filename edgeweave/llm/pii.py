"""Personal data by weak supervision, in DataFrame functions only.

**Base spans.** Four patterns (e-mail, IP, card, phone), leftmost and non-overlapping for each kind; matches that
fail their check (parts to 255, Luhn, number of digits) are dropped without another try. Spark gives the matches
and the pieces between them, and running lengths of both are the positions. The patterns are written
with possessive repetition and a look back to the start of a run, which finds the same matches in time
linear in the text.

**Candidates.** All matches that could be personal data: base spans, matches that fail their check, and matches of
a wider form for each kind (spelt out "at" and "dot", defanged or hexadecimal addresses, numbers without
a plus sign, card numbers inside a longer run of digit groups).

**Labelers** look at the span, at gazetteers of values and cue words, and at the text around it. Each votes
yes, no or abstains. Per kind, expectation-maximisation over the counts of all vote patterns of the corpus
estimates the share of personal data and how often each labeler says yes for personal data and for
the rest, given that it votes. The posterior of a pattern is the soft label of its spans.

**Classifier.** A logistic regression for each kind is trained on the soft labels, over the votes and the shape of
the span, and decides on the candidates. Those with at least ``threshold`` that overlap no base span
are added, the earlier one first where two overlap.

Spans are found once and written with their pattern codes, without text. What is gathered in one row is the count of
each vote pattern and of each feature pattern of a kind: at most 3 ** 6 and 3 ** 6 * 2 ** 4, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from edgeweave.session import cut_lineage, written_table

KINDS = ("email", "ip", "card", "phone")
THRESHOLD, EM_STEPS, FIT_STEPS, RATE, DECAY, AROUND, PIECE = 0.5, 40, 300, 0.5, 0.002, 32, 512
LABELERS, SHAPES = 6, 4

# The base patterns, with possessive repetition where the next character cannot belong to the run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider forms, and what a text must hold before either form is searched.
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:\x20?[\[({]dot[\])}]\x20?[A-Za-z0-9-]++|\x20dot\x20[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++|\x20at\x20[A-Za-z0-9-]++(?:\x20?[\[({]dot[\])}]\x20?[A-Za-z0-9-]++|\x20dot\x20[A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9.\]])(?=[0-9.]++[\[({])[0-9]{1,3}+(?:[\[({]?\.[\])}]?[0-9]{1,3}+){3}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}|[0-9]{4}([\x20.-])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
BASE_NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
WIDE_NEEDS = {
    "email": r"(?i)[\[({]at[\])}]|\x20at\x20[A-Za-z0-9-]++\x20?(?:[\[({]|\x20)?dot",
    "ip": r"[0-9.][\[({]|(?::[0-9A-Fa-f]{1,4}){7}",
    "card": r"[0-9]{14}|[0-9]{4}[\x20.-][0-9]{4,6}[\x20.-][0-9]",
    "phone": r"[0-9)][\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# The gazetteers. Cue words stand shortly before a span, the others in it.
CUES = {
    "email": ("e-mail", "email", "mail", "mailto", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "address", "server", "client", "adresse", "dirección"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "teléfono", "téléphone", "anruf"),
}
NO_CUES = ("version", "release", "isbn", "issn", "sku", "order", "invoice", "serial", "token", "sha", "section", "page", "rfc", "doi")
DOMAINS = ("com", "net", "org", "edu", "gov", "info", "biz", "io", "eu", "uk", "us", "ca", "au", "de", "at", "ch", "fr", "be", "es", "mx", "it", "nl")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0245])"
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


@dataclass(frozen=True)
class Span:
    """A match with the text around it, as columns inside a lambda."""

    hit: Column
    before: Column
    after: Column

    def has(self, pattern: str) -> Column:
        return F.rlike(self.hit, F.lit(pattern))

    @property
    def digits(self) -> Column:
        return F.regexp_replace(self.hit, "[^0-9]+", "")

    @property
    def many(self) -> Column:
        return F.length(self.digits)

    def check(self, kind: str) -> Column:
        """What a base match of the kind must satisfy."""
        if kind == "ip":
            return self.has(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
        if kind == "card":
            return self.many.between(14, 19) & F.call_function("luhn_check", self.digits)
        return self.many.between(10, 15) if kind == "phone" else F.lit(True)

    def worth(self, kind: str) -> Column:
        """Whether a base match that fails its check is a candidate at all."""
        return self.many.between(14, 19) if kind == "card" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 2).when(no, 1).otherwise(0)


def votes(kind: str, wide: bool, span: Span) -> list[Column]:
    """One vote (2 yes, 1 no, 0 abstains) per labeler: pattern, value gazetteer, cue words, context, shape, size."""
    pattern = F.lit(0) if wide else F.when(span.check(kind), 2).otherwise(1)
    cue = F.rlike(span.before, F.lit(rf"(?i)(?<![\p{{L}}])(?:{'|'.join(CUES[kind])})[^\p{{L}}]{{0,8}}$"))
    no_cue = F.rlike(span.before, F.lit(rf"(?i)(?<![\p{{L}}])(?:{'|'.join(NO_CUES)})[^\p{{L}}]{{0,8}}$"))
    inside = F.rlike(span.before, F.lit(r"[\p{L}\p{N}_=/#]$|[0-9][.\-]$")) | F.rlike(span.after, F.lit(r"^(?:[\p{L}\p{N}_/]|[.\-][0-9])"))
    apart = F.rlike(span.before, F.lit(r"(?:^|[\s,;:(\[<|\"'*!?.])$")) & F.rlike(span.after, F.lit(r"^(?:$|[\s,;:)\]>|\"'.!?*$%&#])"))
    if kind == "email":
        known = span.has(rf"(?i)(?:\.|dot[\])}}]?\x20?)(?:{'|'.join(DOMAINS)})$")
        value = _vote(known, ~known)
        shape = _vote(span.has(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*"), span.has(r"^[._%+-]|\.\.|--"))
        length = F.length(span.hit)
        size = _vote(length.between(6, 80), length > 254)
    elif kind == "ip":
        value = _vote(span.has(r"^0*(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])[^0-9]|:"), span.has(r"^0+[^0-9]"))
        shape = _vote(span.has(r"^(?!0[0-9])[0-9]++(?:[^0-9:]++(?!0[0-9])[0-9]++){3}$|:"), span.has(r"(?:^|[^0-9A-Fa-f])0[0-9]"))
        size = _vote(span.has(rf"^{BYTE}(?:[^0-9:]++{BYTE}){{3}}$|:"), ~span.has(":"))
    elif kind == "card":
        value = _vote(F.rlike(span.digits, F.lit(ISSUERS)), ~F.rlike(span.digits, F.lit(ISSUERS)))
        shape = _vote(span.has(r"^[0-9]+$|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}$|^[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}$"), span.has(r"[0-9]"))
        passes = F.call_function("luhn_check", span.digits)
        size = _vote(passes, ~passes)
    else:
        plus = span.has(r"^\+")
        value = F.when(plus, _vote(F.rlike(span.digits, F.lit(CALLING)), F.lit(True))).otherwise(0)
        shape = _vote(span.has(r"\([0-9]{2,4}\)|^\+[0-9]{1,3}[\x20.-]"), span.has(r"^([0-9])[^0-9]*(?:\1[^0-9]*)+$|[\x20.()-]{4}"))
        size = _vote(span.many.between(10, 13), ~span.many.between(9, 15))
    return [pattern, value, _vote(cue, no_cue), _vote(apart & ~inside, inside), shape, size]


def shapes(kind: str, wide: bool, span: Span) -> list[Column]:
    """Features of the span beside the votes: wide form, long, mixed separators, first on its line."""
    return [
        F.lit(wide),
        span.many > 12,
        span.has(r"[.].*[\x20-]|[\x20-].*[.]"),
        F.rlike(span.before, F.lit(r"(?:^|\n)[\p{P}\s]*$")),
    ]


def _code(parts: list[Column], base: int) -> Column:
    code = F.lit(0)
    for p in parts:
        code = code * base + p.cast("int")
    return code


def _matches(text: Column, kind: str, wide: bool) -> Column:
    """``array<struct<kind, start, end, base, votes, shape>>`` of one pattern, by position.

    Runs of ``PIECE`` matches are walked on their own and then moved to their place, so that a text with very
    many matches copies none of its lists over and over.
    """
    pattern = F.lit((WIDE if wide else BASE)[kind])
    needs = (WIDE_NEEDS if wide else BASE_NEEDS)[kind]

    def walked(x: Column) -> Column:
        gaps, hits = x["gaps"], x["hits"]
        count = F.size(hits)

        def step(acc: Column, i: Column) -> Column:
            hit, gap = F.get(hits, i), F.get(gaps, i)
            start = acc["at"] + F.length(gap)
            end = start + F.length(hit)
            after = F.substring(F.get(gaps, i + 1), 1, AROUND)
            span = Span(hit, F.right(gap, F.lit(AROUND)), after)
            holds = F.lit(False) if wide else span.check(kind)
            one = F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                start.cast("long").alias("start"),
                end.cast("long").alias("end"),
                holds.alias("base"),
                _code(votes(kind, wide, span), 3).alias("votes"),
                _code(shapes(kind, wide, span), 2).alias("shape"),
            )
            kept = F.lit(True) if wide else span.worth(kind)
            return F.struct(end.cast("long").alias("at"), F.when(kept, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

        def piece(first: Column) -> Column:
            numbers = F.sequence(first, F.least(first + (PIECE - 1), count - 1))
            return F.aggregate(numbers, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step)

        def moved(acc: Column, p: Column) -> Column:
            there = F.transform(
                p["out"],
                lambda s: F.struct(
                    s["kind"].alias("kind"),
                    (s["start"] + acc["at"]).alias("start"),
                    (s["end"] + acc["at"]).alias("end"),
                    s["base"].alias("base"),
                    s["votes"].alias("votes"),
                    s["shape"].alias("shape"),
                ),
            )
            return F.struct((acc["at"] + p["at"]).alias("at"), F.concat(acc["out"], there).alias("out"))

        none = F.array().cast(SPANS)
        pieces = F.transform(F.sequence(F.lit(0), count - 1, F.lit(PIECE)), piece)
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
        return F.when(count > 0, F.aggregate(pieces, start, moved)["out"]).otherwise(none)

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hits"))
    there = F.contains(text, F.lit(needs)) if needs == "@" else F.rlike(text, F.lit(needs))
    return F.when(there, F.transform(F.array(both), walked)[0]).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<kind:int,start:bigint,end:bigint,base:boolean,votes:int,shape:int>>"


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, wide)``: per row and kind the spans of the base pattern that are candidates, and of the wide one."""
    text = F.col("text")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    base = F.array(*[_matches(text, k, False) for k in KINDS])
    wide = F.array(*[_matches(text, k, True) for k in KINDS])
    return read.select("doc_id", base.alias("base"), wide.alias("wide"))


def _digit(code: Column, place: int, base: int) -> Column:
    return F.floor(code / F.lit(base**place)) % base


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _total(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + value(x))


def _posterior(v: Column, state: Column) -> Column:
    """Probability of personal data given the votes ``v``."""

    def weight(vote: Column, r: Column) -> Column:
        yes, no = F.log(r["yes"] / r["wrong"]), F.log((1 - r["yes"]) / (1 - r["wrong"]))
        return F.when(vote == 2, yes).when(vote == 1, no).otherwise(F.lit(0.0))

    told = F.zip_with(v, state["rates"], weight)
    return _sigmoid(F.log(state["prior"] / (1 - state["prior"])) + _total(told, lambda x: x))


def reliabilities(patterns: DataFrame, steps: int = EM_STEPS) -> DataFrame:
    """``(kind, state)`` from ``(kind, votes, n)``: prior, and per labeler the rates of yes among its votes.

    Rates begin at 0.8 for personal data and 0.2 for the rest, and stay near them where there are few votes: each
    counts as ten votes more, which also keeps the classes from changing places.
    """
    v = F.array(*[_digit(F.col("votes"), LABELERS - 1 - j, 3).cast("int") for j in range(LABELERS)])
    one = F.struct(v.alias("v"), F.col("n").cast("double").alias("n"))
    rows = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    rate = F.struct(F.lit(0.8).alias("yes"), F.lit(0.2).alias("wrong"))
    start = F.struct(F.lit(0.5).alias("prior"), F.array_repeat(rate, LABELERS).alias("rates"))

    def step(state: Column, _: Column) -> Column:
        told = F.transform("rows", lambda x: F.struct(x["v"].alias("v"), x["n"].alias("n"), (x["n"] * _posterior(x["v"], state)).alias("pii")))

        def renewed(items: Column) -> Column:
            def rates(j: Column) -> Column:
                def share(count, yes: float) -> Column:
                    said = _total(items, lambda x: F.when(F.get(x["v"], j) == 2, count(x)).otherwise(0.0))
                    voted = _total(items, lambda x: F.when(F.get(x["v"], j) > 0, count(x)).otherwise(0.0))
                    return (said + 10 * yes) / (voted + 10)

                return F.struct(share(lambda x: x["pii"], 0.8).alias("yes"), share(lambda x: x["n"] - x["pii"], 0.2).alias("wrong"))

            prior = (_total(items, lambda x: x["pii"]) + 1) / (_total(items, lambda x: x["n"]) + 2)
            return F.struct(prior.alias("prior"), F.transform(F.sequence(F.lit(0), F.lit(LABELERS - 1)), rates).alias("rates"))

        return F.transform(F.array(told), renewed)[0]

    return rows.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("state"))


def _features(vote_code: Column, shape_code: Column) -> list[Column]:
    """Votes as 1, -1 or 0, shapes as 1 or 0, and a constant."""
    said = [_digit(vote_code, LABELERS - 1 - j, 3) for j in range(LABELERS)]
    held = [_digit(shape_code, SHAPES - 1 - j, 2) for j in range(SHAPES)]
    return [*[F.when(x == 2, 1.0).when(x == 1, -1.0).otherwise(0.0) for x in said], *[x.cast("double") for x in held], F.lit(1.0)]


def classifiers(patterns: DataFrame, states: DataFrame, steps: int = FIT_STEPS) -> DataFrame:
    """``(kind, weights)``: logistic regressions on the soft labels of all candidates ``(kind, votes, shape, n)``."""
    v = F.array(*[_digit(F.col("votes"), LABELERS - 1 - j, 3).cast("int") for j in range(LABELERS)])
    told = patterns.join(states, "kind").withColumn("y", _posterior(v, F.col("state")))
    one = F.struct(F.array(*_features(F.col("votes"), F.col("shape"))).alias("x"), F.col("y"), F.col("n").cast("double").alias("n"))
    rows = told.groupBy("kind").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    rows = rows.withColumn("all", _total(F.col("rows"), lambda r: r["n"]))
    size = LABELERS + SHAPES + 1

    def step(w: Column, _: Column) -> Column:
        def wrong(r: Column) -> Column:
            p = _sigmoid(_total(F.zip_with(r["x"], w, lambda a, b: a * b), lambda z: z))
            return F.struct(r["x"].alias("x"), (r["n"] / F.col("all") * (p - r["y"])).alias("e"))

        def moved(items: Column) -> Column:
            slope = lambda j: _total(items, lambda r: F.get(r["x"], j) * r["e"])
            return F.transform(w, lambda weight, j: weight * (1 - RATE * DECAY) - RATE * slope(j))

        return F.transform(F.array(F.transform("rows", wrong)), moved)[0]

    start = F.array_repeat(F.lit(0.0), size)
    return rows.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("weights"))


def trained(found: DataFrame) -> list[list[float] | None]:
    """The weights of each kind, from all candidates; None for a kind without any."""
    each = found.select(F.explode(F.concat(F.flatten("base"), F.flatten("wide"))).alias("s")).select("s.*")
    patterns = cut_lineage(each.groupBy("kind", "votes", "shape").agg(F.count(F.lit(1)).alias("n")))
    states = reliabilities(patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    weights = {r.kind: r.weights for r in classifiers(patterns, states).collect()}
    return [weights.get(k) for k in range(len(KINDS))]


def _overlaps(own: Column, start: Column, end: Column) -> Column:
    """Whether a span overlaps one of ``own``, which are in order and apart: the last that begins before its end tells."""
    steps = F.array(*[F.lit(1 << b) for b in range(26, -1, -1)])

    def step(at: Column, width: Column) -> Column:
        goes = (at + width <= F.size(own)) & (F.get(own, at + width - 1)["start"] < end)
        return F.when(goes, at + width).otherwise(at)

    return F.coalesce(F.get(own, F.aggregate(steps, F.lit(0), step) - 1)["end"] > start, F.lit(False))


def _listed(items: Column) -> Column:
    """``kind:start:end`` by start, then kind."""
    ordered = F.sort_array(F.transform(items, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*map(F.lit, KINDS))
    told = F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(told, ",")


def _added(base: Column, candidates: Column) -> Column:
    """Accepted candidates that overlap no base span; of two that overlap, the one that begins first, then by kind."""
    ordered = F.sort_array(F.transform(candidates, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    free = F.filter(ordered, lambda s: ~F.exists(base, lambda own: _overlaps(own, s["start"], s["end"])))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def step(acc: Column, s: Column) -> Column:
        taken = s["start"] >= acc["at"]
        return F.struct(
            F.when(taken, s["end"]).otherwise(acc["at"]).alias("at"),
            F.when(taken, F.concat(acc["out"], F.array(s))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(free, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step)["out"]


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans)`` for every row of ``docs (doc_id, text)``.

    The counts are those of base spans, ``n_added`` that of all others; ``spans`` lists both as
    ``kind:start:end`` in code points, end exclusive, by start and kind. A null or empty text has no spans, an
    empty list and the hash of an empty string; a null id keeps its row; repeated rows count as documents of their
    own and stay; an empty table gives no rows. Columns beyond the two are ignored.
    """
    found, _ = written_table(spans(docs), "spans")
    return with_model(found, trained(found), threshold)


def with_model(found: DataFrame, model: list[list[float] | None], threshold: float = THRESHOLD) -> DataFrame:
    """The result of ``personal_data`` for rows of ``spans`` and weights for each kind."""
    base = F.transform("base", lambda own: F.filter(own, lambda s: s["base"]))

    def accepted(s: Column) -> Column:
        x = F.array(*_features(s["votes"], s["shape"]))
        sums = [
            F.lit(-1e9) if w is None else _total(F.zip_with(x, F.array(*map(F.lit, w)), lambda a, b: a * b), lambda z: z) for w in model
        ]
        return ~s["base"] & (_sigmoid(F.get(F.array(*sums), s["kind"])) >= threshold)

    candidates = F.filter(F.concat(F.flatten("base"), F.flatten("wide")), accepted)
    rows = found.select("doc_id", base.alias("own"), candidates.alias("candidates"))
    rows = rows.withColumn("added", _added(F.col("own"), F.col("candidates")))
    plain = F.transform(F.flatten("own"), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    counts = [F.size(F.get("own", F.lit(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.size("added").cast("long").alias("n_added"),
        F.sha2(_listed(F.flatten("own")), 256).alias("base_sha256"),
        _listed(F.concat(plain, "added")).alias("spans"),
    )
