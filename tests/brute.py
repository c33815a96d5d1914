"""Plain Python counterparts for small graphs."""

from collections import Counter, defaultdict
import random


def two_paths(pairs):
    return Counter((a, b, d) for a, b in pairs for c, d in pairs if b == c and a != d)


def triangles(pairs):
    have = Counter(pairs)
    rows = Counter()
    for (a, b, c), n in two_paths(pairs).items():
        if have[(c, a)]:
            rows[(a, b, c)] += n * have[(c, a)]
    return rows


def semi_triangles(pairs):
    have = set(pairs)
    rows = Counter()
    for a, b in pairs:
        for x, c in have:
            if x == b and (c, a) in have:
                rows[(a, b, c)] += 1
    return rows


def canonical(pairs):
    return {t for t in triangles(pairs) if len(set(t)) == 3 and t[0] == min(t)}


def pagerank(pairs, iterations, alpha=0.15, sink=None):
    nodes = sorted({x for p in pairs for x in p} - {sink})
    out = Counter(a for a, _ in pairs)
    n = len(nodes)
    rank = {v: 1.0 / n for v in nodes}
    masses = []
    for _ in range(iterations):
        got = defaultdict(float)
        for a, b in pairs:
            got[b] += rank[a] / out[a]
        mass = sum(rank[v] for v in nodes if not out[v]) + got.pop(sink, 0.0)
        masses.append(mass)
        rank = {v: (1 - alpha) * (got[v] + mass / n) + alpha / n for v in nodes}
    return rank, masses


def random_graph(seed, nodes=14, edges=60):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]


def hub_graph(seed=7, others=90, extra=120):
    """Hubs 5 and 50 tied to nearly all nodes both ways and to each other, with copies and loops."""
    rng = random.Random(seed)
    pairs = []
    for v in range(100, 100 + others):
        pairs += [(5, v), (v, 50)]
        if v % 3 == 0:
            pairs += [(v, 5), (50, v)]
    pairs += [(50, 5), (50, 5), (5, 50), (5, 5), (50, 50)]
    pairs += [(rng.randrange(100, 100 + others), rng.randrange(100, 100 + others)) for _ in range(extra)]
    return pairs
