from collections import Counter
import hashlib
import math

import numpy as np
import pytest
import regex

from edgeweave.llm import pii, queries
from edgeweave.sources.derived import table

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def only_digits(hit):
    return regex.sub("[^0-9]+", "", hit)


def check(kind, hit):
    digits = only_digits(hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def plain_base(text):
    """Checked matches of the patterns as they are given."""
    found = []
    for k, kind in enumerate(PLAIN):
        for m in regex.finditer(PLAIN[kind], text or ""):
            if check(kind, m[0]):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def vote(yes, no):
    return 2 if yes else 1 if no else 0


def plain_votes(kind, wide, hit, before, after):
    has = lambda p, s=hit: bool(regex.search(p, s))
    digits = only_digits(hit)
    cue = lambda words: has(rf"(?i)(?<!\p{{L}})(?:{'|'.join(words)})[^\p{{L}}]{{0,8}}\Z", before)
    inside = has(r"[\p{L}\p{N}_=/#]\Z|[0-9][.\-]\Z", before) or has(r"^(?:[\p{L}\p{N}_/]|[.\-][0-9])", after)
    clear = has(r"(?:^|[\s,;:(\[<|\"'*!?.])\Z", before) and has(r"^(?:\Z|[\s,;:)\]>|\"'.!?*$%&#])", after)
    byte = pii.BYTE
    if kind == "email":
        known = hit.lower().rsplit(".", 1)[-1].rsplit(" ", 1)[-1].rsplit("]", 1)[-1].rsplit(")", 1)[-1].rsplit("}", 1)[-1] in pii.DOMAINS
        own = [vote(known, True), 2 if hit[0] not in "._%+-" else 1, vote(6 <= len(hit) <= 80, len(hit) > 254)]
    elif kind == "ip":
        first = regex.match("[0-9]*", hit)[0]
        own = [vote(":" in hit or (first and 1 <= int(first) <= 223), has("^0+[^0-9]"))]
        parts = regex.split("[^0-9]+", hit)
        own.append(vote(":" in hit or not any(len(p) > 1 and p[0] == "0" for p in parts), True))
        own.append(vote(":" in hit or has(rf"^{byte}(?:[^0-9:]+{byte}){{3}}\Z"), True))
    elif kind == "card":
        groups = r"^[0-9]+\Z|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}\Z|^[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}\Z"
        own = [vote(has(pii.ISSUERS, digits), True), vote(has(groups), True), vote(luhn(digits), True)]
    else:
        same = len(set(digits)) == 1 and hit[0].isdigit()
        own = [vote(has(pii.CALLING, digits), True) if hit[0] == "+" else 0]
        own.append(vote(has(r"\([0-9]{2,4}\)|^\+[0-9]{1,3}[ .-]"), same or has("[ .()-]{4}")))
        own.append(vote(10 <= len(digits) <= 13, not 9 <= len(digits) <= 15))
    pattern = 0 if wide else 2 if check(kind, hit) else 1
    return (pattern, own[0], vote(cue(pii.CUES[kind]), cue(pii.NO_CUES)), vote(clear and not inside, inside), own[1], own[2])


def plain_candidates(text):
    """(kind, start, end, base, votes, shape) of every candidate."""
    found, text = [], text or ""
    for k, kind in enumerate(PLAIN):
        for wide, pattern in ((False, PLAIN[kind]), (True, pii.WIDE[kind])):
            hits = [(m.start(), m.end()) for m in regex.finditer(pattern, text)]
            edges = [0, *(e for _, e in hits)], [*(s for s, _ in hits), len(text)]
            for i, (a, b) in enumerate(hits):
                hit, before, after = text[a:b], text[edges[0][i] : a][-32:], text[b : edges[1][i + 1]][:32]
                digits = only_digits(hit)
                if not wide and kind == "card" and not 14 <= len(digits) <= 19:
                    continue
                mixed = bool(regex.search(r"[.].*[ -]|[ -].*[.]", hit))
                shape = (wide, len(digits) > 12, mixed, bool(regex.search(r"(?:^|\n)[\p{P}\s]*\Z", before)))
                found.append((k, a, b, not wide and check(kind, hit), plain_votes(kind, wide, hit, before, after), shape))
    return found


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_model(candidates):
    """Soft labels by expectation-maximisation and a regression on them, for each kind."""
    models = []
    for k in range(4):
        own = [c for c in candidates if c[0] == k]
        if not own:
            models.append(None)
            continue
        v = np.array([c[4] for c in own])
        prior, yes, wrong = 0.5, np.full(6, 0.8), np.full(6, 0.2)

        def posterior():
            told = np.where(v == 2, np.log(yes / wrong), np.where(v == 1, np.log((1 - yes) / (1 - wrong)), 0)).sum(1)
            return sigmoid(math.log(prior / (1 - prior)) + told)

        for _ in range(pii.EM_STEPS):
            r = posterior()[:, None]
            prior, yes, wrong = (
                (r.sum() + 1) / (len(own) + 2),
                ((r * (v == 2)).sum(0) + 8) / ((r * (v > 0)).sum(0) + 10),
                (((1 - r) * (v == 2)).sum(0) + 2) / (((1 - r) * (v > 0)).sum(0) + 10),
            )
        y = posterior()
        x = np.array([[*(1.0 if s == 2 else -1.0 if s == 1 else 0.0 for s in c[4]), *map(float, c[5]), 1.0] for c in own])
        w = np.zeros(11)
        for _ in range(pii.FIT_STEPS):
            w = w * (1 - pii.RATE * pii.DECAY) - pii.RATE * ((sigmoid(x @ w) - y) @ x) / len(own)
        models.append(w)
    return models


def plain_result(docs):
    found = [plain_candidates(t) for _, t in docs]
    models = plain_model([c for own in found for c in own])
    out = []
    for (doc_id, text), own in zip(docs, found):
        base = plain_base(text)
        added, at = [], 0
        for k, a, b, is_base, votes, shape in sorted(own, key=lambda c: (c[1], c[0], c[2])):
            x = [*(1.0 if s == 2 else -1.0 if s == 1 else 0.0 for s in votes), *map(float, shape), 1.0]
            if not is_base and sigmoid(np.dot(models[k], x)) >= pii.THRESHOLD and a >= at and all(e <= a or b <= s for s, _, e in base):
                added.append((a, k, b))
                at = b
        listed = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        counts = Counter(k for _, k, _ in base)
        out.append((doc_id, *(counts[k] for k in range(4)), len(added), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added)))
    return Counter(out)


ODD = [
    "", None, "no data at all", "a@b.c_d@e.f-g.h @x.y a@b a..b@c.de.",
    "mail me: jane.doe@mail.example.com, or john (at) host (dot) org, joe at host dot com; he sat at home.Then",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0001.002.03.255 then 10[.]0[.]0[.]1 v1.2.3.4 1.2.3",
    "fe80:0:0:0:1:2:3:4 is an address, 12:30:45 is not",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1112 5500005555555559 1234567890123",
    "4111111111111111 5500005555555559 joined",
    "call +1 (017) 555-7713 4111111111111111 or +49 30 1234567 or (030) 123-4567, 030 123 4567, 555-123-4567.",
    "+1 (017) 555-7713\n+12 345\n+1((((((((2 +33 1 23 45 67 89",
    "ünï\U0001d400çödé +1 (017) 555-7713 \U0001f600 x@y.de \U0001f600 8.8.8.8é",
    "order 4111111111111111, card: 4111 1111 1111 1112, isbn 97831614841001",
    "1" * 3_000 + " " + "a" * 3_000 + " " + "x." * 3_000 + " +1" + " " * 3_000 + "a@b" + ".c" * 3_000,
    ("tel +1 (017) 555-7713, " + "host 10.0.0.1; " + "x@y.org " + "4111111111111111 99 ") * 700,
]
DOCS = [*enumerate(ODD), (None, "null id 1.1.1.1"), (3, "again 1.1.1.1"), (3, "again 1.1.1.1")]


def result(frame):
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_odd_texts(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in DOCS], "doc_id long, text string, spans string, kind int")
    got, want = result(pii.personal_data(docs)), plain_result(DOCS)
    assert got - want == want - got == Counter()


def test_added_spans(spark):
    """Cards and numbers that a base pattern swallows with their neighbours come back; a wrong checksum does not."""
    texts = [f"+1 (0{i % 90 + 10}) 555-{1000 + i} and 4111111111111111 or 4111111111111112, 10.0.0.{i % 250} x{i}@mail.example.com" for i in range(200)]
    texts += ["4111111111111111 5500005555555559", "+1 (017) 555-7713 4111111111111111"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert all(rows[i].n_added == 0 for i in range(200))
    assert rows[200].spans == "card:0:16,card:17:33" and rows[200].n_card == 0
    assert rows[201].spans == "phone:0:17,card:18:34"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(docs).collect() == []


def test_overlap_search(spark):
    spans = "array(" + ",".join(f"named_struct('start', {i * 10}L, 'end', {i * 10 + 4}L)" for i in range(1, 40)) + ")"
    rows = spark.range(0, 420).selectExpr("id", f"{spans} as own")
    for width in (1, 5, 7, 25):
        found = rows.select("id", pii._overlaps(pii.F.col("own"), pii.F.col("id"), pii.F.col("id") + width).alias("o")).collect()
        assert all(r.o == any(r.id < i * 10 + 4 and i * 10 < r.id + width for i in range(1, 40)) for r in found)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got, want = result(queries.op11_weak_pii(spark, sf)), plain_result(docs)
    assert got - want == want - got == Counter()
