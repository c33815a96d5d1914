"""Directed three-cycles a -> b -> c -> a.

The cycles are found once each, from their lowest node in the order of degree, then id. A node of
a graph with E links has at most ``sqrt(2 * E)`` neighbours above it in that order, so the two-hop
paths that start the search stay below ``2 * E ** 1.5``, and a hub, however large, centres only
paths among still larger hubs. The plain self-join lists in-degree times out-degree paths for
each hub instead. The rotations are added to the finished cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edgeweave.functions.skew import BROADCAST_ROWS, HEAVY_FLOOR, cell_of, every_cell, join_in_cells
from edgeweave.operators.edges import link_counts
from edgeweave.operators.paths import PAIRS, degree_line, grid_join, grid_of, hub_nodes, node_degrees, parts_of
from edgeweave.session import counted_table, drop_table, written_table

STRATEGIES = ("auto", "merge", "shuffle_hash", "broadcast")
FILTER_BITS = 1 << 26  # of the membership filter: at most 2 ** 20 words of 64 bits
KINDS = ("multi", "distinct", "semi")


def _hinted(df: DataFrame, strategy: str) -> DataFrame:
    return df if strategy == "auto" else df.hint(strategy)


def _check(strategy: str, kind: str = "multi") -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")


def _settle(rows: int, strategy: str, max_rows: int) -> str:
    return "auto" if strategy == "broadcast" and rows > max_rows else strategy


def _ranked(links: DataFrame, floor: int) -> DataFrame:
    """Links with the degree of both ends.

    Each end is one join to the table of degrees; the links of a hub are spread over cells for it.
    """
    sizes = node_degrees(links)
    hubs = hub_nodes(links, floor)
    degree = F.col("ins") + F.col("outs")
    out = links
    for end, other in (("src", "dst"), ("dst", "src")):
        degrees = sizes.select(F.col("node").alias(end), degree.alias(f"{end}_degree"))
        out = join_in_cells(out, degrees, end, [other], hubs.withColumnRenamed("node", end))
    line = degree_line(sizes, floor)
    return out.withColumns({f"{end}_parts": parts_of(F.col(f"{end}_degree"), line) for end in ("src", "dst")})


def ranked_links(edges: DataFrame, floor: int = HEAVY_FLOOR) -> tuple[DataFrame, int]:
    """Counted links with the degree and cell count of both ends, as a table in the shared folder, and their number.

    The search reads it three times (ways out, ways in, closing links). Written once, the joins
    that attach the degrees are not repeated, and a lost executor costs a scan. So are the counted links that
    they read, until then: what makes the edges is done once, and its shuffle files go first.
    """
    links, path = written_table(link_counts(edges), "links")
    table, _, rows = counted_table(_ranked(links, floor), "ranked-links")
    drop_table(links.sparkSession, path)
    return table, rows


def ascending() -> Column:
    """Whether a ranked link leads to the higher end, in the order of degree, then id; loops do not."""
    return (F.col("src_degree") < F.col("dst_degree")) | (
        (F.col("src_degree") == F.col("dst_degree")) & (F.col("src") < F.col("dst"))
    )


def _grid(ranked: DataFrame, rows: int, budget: int) -> DataFrame | None:
    """The grid of the nodes whose ways make more than ``budget`` pairs, as a table of known size; None without any.

    A node has at most ``2 * sqrt(rows)`` ways in and out together, beside a loop, so few links have none.
    """
    if 2 * rows <= budget:
        return None
    up = ascending()
    ways = ranked.select(
        F.when(up, F.col("src")).otherwise(F.col("dst")).alias("v"),
        F.when(up, 0).otherwise(1).cast("long").alias("ins"),
        F.when(up, 1).otherwise(0).cast("long").alias("outs"),
    )
    sizes = ways.groupBy("v").agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs"))
    grid, _, nodes = counted_table(grid_of(sizes, "v", budget), "grid")
    if not nodes:
        return None
    return F.broadcast(grid) if nodes <= BROADCAST_ROWS else grid


def _wedges(ranked: DataFrame, rows: int, strategy: str, budget: int = PAIRS) -> DataFrame:
    """Paths u -> v -> w around their lowest node v, with ``salts``, the cells of the pair (w, u).

    Each link joins in on one side only: as way out of its lower end, or as way into it. A loop is
    a way into its node, so that walks through one loop are found too. The grid that splits a
    crowded v is sized by the ways that are left after this choice, not by v's degree.
    """
    up = ascending()
    out = ranked.filter(up).select(
        F.col("src").alias("v"), F.col("dst").alias("w"), F.col("n").alias("n_vw"), F.col("dst_parts").alias("w_parts")
    )
    into = ranked.filter(~up).select(
        F.col("dst").alias("v"), F.col("src").alias("u"), F.col("n").alias("n_uv"), F.col("src_parts").alias("u_parts")
    )
    hint = None if strategy == "auto" else strategy
    met = grid_join(into, out, "v", _grid(ranked, rows, budget), ("u", "w"), hint=hint)
    return met.select("v", "w", "u", "n_vw", "n_uv", F.least("w_parts", "u_parts").alias("salts"))


def _closed(wedges: DataFrame, ranked: DataFrame, strategy: str) -> DataFrame:
    """Wedges with the copies of the closing link w -> u, which is looked up by both ends.

    A pair of hubs can end very many paths, so its paths are spread over cells by v; the cells of
    all links together stay below a small multiple of the links, because a pair gets no more cells
    than its smaller hub has. A broadcast ships each closing link once, without cells.
    """
    closing = ranked.select(F.col("src").alias("w"), F.col("dst").alias("u"), F.col("n").alias("n_wu"), "src_parts", "dst_parts")
    if strategy == "broadcast":
        found = wedges.join(F.broadcast(closing), ["w", "u"])
    else:
        cells = closing.withColumn("salt", every_cell(F.least("src_parts", "dst_parts")))
        found = wedges.withColumn("salt", cell_of(F.col("salts"), F.col("v"))).join(_hinted(cells, strategy), ["w", "u", "salt"])
    return found.select("v", "w", "u", "n_vw", "n_wu", "n_uv")


def _spot(first: str, second: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(first, second), F.lit(bits))


def pair_filter(links: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """A bitmap of the hashed ``(src, dst)`` pairs, ``(word, members)``: at most ``bits / 64`` rows, whatever the links."""
    spots = links.select(_spot("src", "dst", bits).alias("spot"))
    words = spots.selectExpr("shiftright(spot, 6) as word", "shiftleft(1L, cast(spot & 63 as int)) as bit")
    return words.groupBy("word").agg(F.bit_or("bit").alias("members"))


def possible_pairs(rows: DataFrame, first: str, second: str, members: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose ``(first, second)`` the filter may hold: all that it holds, and some more by equal hashes."""
    spotted = rows.withColumn("spot", _spot(first, second, bits)).withColumn("word", F.expr("shiftright(spot, 6)"))
    met = spotted.join(F.broadcast(members), "word")  # at most bits / 64 rows
    return met.filter("getbit(members, cast(spot & 63 as int)) = 1").select(*rows.columns)


def closed_walks(
    ranked: DataFrame,
    rows: int,
    strategy: str = "auto",
    max_broadcast_rows: int = BROADCAST_ROWS,
    budget: int = PAIRS,
    filter_bits: int | None = None,
) -> DataFrame:
    """Closed walks of three edges over at least two nodes, each once: ``(v, w, u, n_vw, n_wu, n_uv)``.

    ``filter_bits`` checks the ends of a path against a bitmap of that many bits of all links before the
    path is shuffled to its closing link; the join after it decides. It pays where few paths close.
    """
    strategy = _settle(rows, strategy, max_broadcast_rows)
    wedges = _wedges(ranked, rows, strategy, budget)
    if filter_bits:
        wedges = possible_pairs(wedges, "w", "u", pair_filter(ranked, filter_bits), filter_bits)
    return _closed(wedges, ranked, strategy)


def _loops(ranked: DataFrame) -> DataFrame:
    """Links of a node to itself; three times the same loop is a closed walk on one node."""
    return ranked.filter(F.col("src") == F.col("dst"))


def _copies(kind: str, first: str, second: str, third: str, wide: bool = False) -> Column:
    if kind == "multi":
        return _product([first, second, third], wide)
    return F.col(first) if kind == "semi" else F.lit(1).cast("long")


def _product(columns: list[str], wide: bool) -> Column:
    """Product of copy counts; beyond 63 bits it raises, ``wide`` gives up to 38 digits instead."""
    kind = "decimal(38,0)" if wide else "long"
    out = F.col(columns[0]).cast(kind)
    for c in columns[1:]:
        out = (out * F.col(c).cast("decimal(19,0)" if wide else "long")).cast(kind)
    return out


def triangles(
    edges: DataFrame,
    kind: str = "multi",
    strategy: str = "auto",
    floor: int = HEAVY_FLOOR,
    max_broadcast_rows: int = BROADCAST_ROWS,
    wide: bool = False,
    budget: int = PAIRS,
    filter_bits: int | None = None,
) -> DataFrame:
    """Every rotation of every closed walk as ``(a, b, c, copies)``.

    ``multi`` counts repeated edges in ``copies`` and leaves out a = c, as a chain of inner joins
    does. ``distinct`` ignores repeated edges. ``semi`` takes a -> b from the raw edges and only
    tests whether b -> c and c -> a exist, so ``copies`` is that of a -> b and a = c may occur. A
    product of copies beyond 63 bits raises; ``wide`` gives decimals. ``floor`` and ``budget`` size the
    cells, ``filter_bits`` a membership filter before the closing join; none changes the rows.
    """
    _check(strategy, kind)
    ranked, count = ranked_links(edges, floor)
    walks = closed_walks(ranked, count, strategy, max_broadcast_rows, budget, filter_bits)
    return rotated(walks, ranked, kind, wide)


def rotated(walks: DataFrame, ranked: DataFrame, kind: str = "multi", wide: bool = False) -> DataFrame:
    """The rows of ``triangles`` from closed walks."""

    def turn(a: str, b: str, c: str) -> Column:
        copies = _copies(kind, f"n_{a}{b}", f"n_{b}{c}", f"n_{c}{a}", wide)
        return F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(c).alias("c"), copies.alias("copies"))

    turns = F.array(turn("v", "w", "u"), turn("w", "u", "v"), turn("u", "v", "w"))
    rows = walks.select(F.explode(turns).alias("t")).select("t.*")
    if kind == "semi":
        loop, n = F.col("src"), F.col("n").alias("copies")
        return rows.unionByName(_loops(ranked).select(loop.alias("a"), loop.alias("b"), loop.alias("c"), n))
    rows = rows.filter(F.col("a") != F.col("c"))
    return rows.drop("copies") if kind == "distinct" else rows


def triangles_canonical(
    edges: DataFrame,
    strategy: str = "auto",
    floor: int = HEAVY_FLOOR,
    budget: int = PAIRS,
    filter_bits: int | None = None,
) -> DataFrame:
    """Each cycle of three different nodes once, smallest id first."""
    _check(strategy)
    return canonical(closed_walks(*ranked_links(edges, floor), strategy, budget=budget, filter_bits=filter_bits))


def canonical(walks: DataFrame) -> DataFrame:
    """The rows of ``triangles_canonical`` from closed walks."""
    walks = walks.filter((F.col("v") != F.col("u")) & (F.col("w") != F.col("u")))
    v, w, u = F.col("v"), F.col("w"), F.col("u")
    low = F.least(v, w, u)

    def pick(if_v: Column, if_w: Column, if_u: Column) -> Column:
        return F.when(v == low, if_v).when(w == low, if_w).otherwise(if_u)

    return walks.select(pick(v, w, u).alias("a"), pick(w, u, v).alias("b"), pick(u, v, w).alias("c"))


def _pair_weights(wedges: DataFrame, kind: str, wide: bool) -> DataFrame:
    """Paths u -> v -> w folded per pair into ``(w, u, scaled, plain)``.

    With n copies of the closing link the pair stands for ``scaled * n + plain`` triangle rows. The
    fold runs before the shuffle, so all paths between two hubs become one row per task.
    """
    scaled, plain = _weights(kind, wide)
    return wedges.groupBy("w", "u").agg(F.sum(scaled).alias("scaled"), F.sum(plain).alias("plain"))


def _weights(kind: str, wide: bool) -> tuple[Column, Column]:
    proper = (F.col("v") != F.col("u")) & (F.col("w") != F.col("u"))
    turns = F.when(proper, 3).otherwise(2).cast("long")
    none = F.lit(0).cast("long")
    if kind == "multi":
        return _product(["n_vw", "n_uv"], wide) * turns, none
    return (none, turns) if kind == "distinct" else (F.lit(1).cast("long"), F.col("n_vw") + F.col("n_uv"))


def triangle_count(
    edges: DataFrame,
    kind: str = "multi",
    strategy: str = "auto",
    floor: int = HEAVY_FLOOR,
    max_broadcast_rows: int = BROADCAST_ROWS,
    wide: bool = False,
    budget: int = PAIRS,
) -> DataFrame:
    """Rows ``triangles`` would have (copies counted) and rows div 3, without listing them.

    Paths between two hubs are folded per pair before they are closed; all others are summed straight
    after the closing join, which moves only sums. A count beyond 63 bits raises, ``wide`` gives decimals.
    """
    _check(strategy, kind)
    ranked, count = ranked_links(edges, floor)
    strategy = _settle(count, strategy, max_broadcast_rows)
    wedges = _wedges(ranked, count, strategy, budget)
    total = F.sum(F.col("rows"))
    number = "decimal(38,0)" if wide else "long"
    rows = lambda scaled, plain, n: (scaled.cast(number) * n + plain).cast(number).alias("rows")
    scaled, plain = _weights(kind, wide)
    apart = _closed(wedges.filter("salts = 1"), ranked.filter("src_parts = 1 or dst_parts = 1"), strategy)
    apart = apart.select(rows(scaled, plain, F.col("n_wu"))).agg(total.alias("rows"))
    pairs = _pair_weights(wedges.filter("salts > 1"), kind, wide)
    between = ranked.filter("src_parts > 1 and dst_parts > 1").select(F.col("src").alias("w"), F.col("dst").alias("u"), "n")
    folded = pairs.join(_hinted(between, strategy), ["w", "u"]).select(rows(F.col("scaled"), F.col("plain"), F.col("n")))
    both = apart.unionByName(folded.agg(total.alias("rows")))
    if kind == "semi":
        both = both.unionByName(_loops(ranked).agg(F.sum("n").cast(number).alias("rows")))
    both = both.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast(number).alias("rows"))
    third = F.floor((F.col("rows") - F.col("rows") % 3) / 3).cast(number) if wide else F.expr("rows div 3")
    return both.select("rows", third.alias("triangles"))
